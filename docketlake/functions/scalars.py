"""Scalar functions over Columns (F1-F32); none is a Python function on rows."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Legal suffixes, honorifics and generations that names lose, as the public sources write them.
LEGAL_SUFFIXES = ("INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "LTD", "LIMITED", "LLC", "LP", "LLP", "PLC", "SA", "NV", "AG")
HONORIFICS = ("HON", "MR", "MRS", "MS", "DR")
GENERATIONS = ("JR", "SR", "II", "III", "IV")
# How filings cite bills, longest form first, with the token of each type.
BILL_FORMS = (("HConRes", "H.Con.Res."), ("SConRes", "S.Con.Res."), ("HJRes", "H.J.Res."), ("SJRes", "S.J.Res."), ("HRes", "H.Res."), ("SRes", "S.Res."), ("HR", "H.R."), ("S", "S."))
# Asset codes of House reports.
ASSET_CODES = {
    "ST": "stock", "PS": "stock", "OP": "option", "OT": "other", "GS": "bond", "CS": "bond", "AB": "bond", "CT": "crypto",
    "MF": "fund", "EF": "fund", "MO": "fund", "HE": "fund", "PE": "fund", "RE": "fund",
}
# Words that tell the kind of asset where no code does, in order of precedence.
ASSET_WORDS = (
    ("option", r"(?i)\b(call|put|option)s?\b"),
    ("bond", r"(?i)\b(bond|note|notes|bill|treasur\w*|debenture|municipal)\b"),
    ("crypto", r"(?i)\b(bitcoin|ethereum|crypto\w*|token|coin)\b"),
    ("fund", r"(?i)\b(fund|etf|trust|index)\b"),
)
# Words of Senate reports for kinds of assets and owners, in order of precedence, and beginnings of sides.
SENATE_ASSETS = (("option", "option"), ("crypto", "crypto"), ("bond", "corporate bond|municipal|treasury|note|bond"), ("fund", "mutual fund|etf|exchange traded"), ("stock", "stock"))
SENATE_OWNERS = (("spouse", "spouse"), ("joint", "joint"), ("dependent", "child|dependent"), ("self", "self"))
SENATE_SIDES = ("purchase", "sale", "exchange")
# Sides of House reports.
HOUSE_SIDES = {"P": "buy", "S": "sell", "E": "exchange"}
# What may stand after a company's name: the state of a registrant, a share class.
STATE_TAIL, CLASS_TAIL = r"\s*/[A-Z]{2}/?\s*$", r"[\s-]*\bCL(?:ASS)?\s+[A-Z]$"


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(trimmed != "", trimmed)


def parse_number(c: Column, drop: str = "$,") -> Column:
    """A number without currency signs and grouping commas; anything else is null."""
    return F.translate(blank_to_null(c), drop, "").try_cast("double")


def parse_flag(c: Column) -> Column:
    """1, true, y and yes in any case are true; all else, null included, is false."""
    return F.coalesce(F.lower(F.trim(c)).isin("1", "true", "y", "yes"), F.lit(False))


def _date(year: Column, month: Column, day: Column) -> Column:
    """A calendar date; impossible days such as 02/31 are null."""
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def _matched(c: Column, pattern: str, year: int, month: int, day: int) -> Column:
    part = lambda k: F.regexp_extract(c, pattern, k)
    return F.when(c.rlike(pattern), _date(part(year), part(month), part(day)))


def slash_date(c: Column) -> Column:
    """M/D/YYYY, with or without a time after it."""
    return _matched(F.trim(c), r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:\s.*)?$", 3, 1, 2)


def month_first_date(c: Column) -> Column:
    """MMDDYYYY."""
    return _matched(F.trim(c), r"^(\d{2})(\d{2})(\d{4})$", 3, 1, 2)


def compact_date(c: Column) -> Column:
    """YYYYMMDD."""
    return _matched(F.trim(c), r"^(\d{4})(\d{2})(\d{2})$", 1, 2, 3)


def iso_date(c: Column) -> Column:
    """A leading YYYY-MM-DD."""
    return _matched(F.trim(c), r"^(\d{4})-(\d{2})-(\d{2})", 1, 2, 3)


def oracle_date(c: Column) -> Column:
    """DD-MON-YYYY."""
    pattern = r"^(\d{1,2})-([A-Za-z]{3})-(\d{4})$"
    months = F.array(*map(F.lit, "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()))
    text = F.trim(c)
    month = F.array_position(months, F.upper(F.regexp_extract(text, pattern, 2)))
    return F.when(text.rlike(pattern) & (month > 0), _date(F.regexp_extract(text, pattern, 3), month.cast("string"), F.regexp_extract(text, pattern, 1)))


def any_date(c: Column) -> Column:
    """DD-MON-YYYY, YYYY-MM-DD or YYYYMMDD, whichever fits."""
    return F.coalesce(oracle_date(c), iso_date(c), compact_date(c))


def partial_date(c: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD as text, never padded; else null."""
    return F.when(F.trim(c).rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.trim(c))


def pad_cik(c: Column) -> Column:
    return F.lpad(F.trim(c).try_cast("bigint").cast("string"), 10, "0")


def amount_range(c: Column) -> Column:
    """A struct (min, max) from a disclosed range; null if it is none (F8). Bounds stay bounds: no midpoint.

    "None..." is 0 to 1000; "Over X" and "X +" have no upper bound; "A - B" (any dash) needs A <= B.
    """
    text = F.trim(c)
    money = lambda x: F.when(F.regexp_replace(x, r"[$,\s]", "").rlike(r"^\d+(\.\d+)?$"), F.regexp_replace(x, r"[$,\s]", "").try_cast("double"))
    pair = lambda low, high: F.struct(low.alias("min"), high.cast("double").alias("max"))
    open_ended = F.coalesce(
        F.when(text.rlike(r"(?i)^over\s+."), money(F.regexp_extract(text, r"(?i)^over\s+(.+)$", 1))),
        F.when(text.rlike(r"\+$"), money(F.regexp_extract(text, r"^(.*?)\s*\+$", 1))),
    )
    sides = F.split(text, r"\s*[-–—]\s*", -1)
    low, high = money(F.get(sides, F.lit(0))), money(F.get(sides, F.lit(1)))
    return (
        F.when(text.rlike(r"(?i)^none\b"), pair(F.lit(0.0), F.lit(1000.0)))
        .when(open_ended.isNotNull(), pair(open_ended, F.lit(None)))
        .when((F.size(sides) == 2) & (high >= low), pair(low, high))
    )


def entity_name(c: Column) -> Column:
    """A company name for comparison (F9): upper case, no state tag, share class, punctuation or legal suffix.

    Of the words that are left, those up to the last that is no legal suffix; the first stays in any case.
    """
    bare = F.replace(F.regexp_replace(F.upper(c), STATE_TAIL, ""), F.lit("&"), F.lit(" AND "))
    words = F.filter(F.split(F.regexp_replace(bare, CLASS_TAIL, ""), r"[\s.,'()]+"), lambda w: w != "")
    last = F.array_max(F.transform(words, lambda w, i: F.when(w.isin(*LEGAL_SUFFIXES), 1).otherwise(i + 1)))
    return F.array_join(F.slice(words, 1, F.coalesce(last, F.lit(0))), " ")


def name_tokens(c: Column) -> Column:
    """Words of a person's name in upper case without honorifics and generations (F10); null gives none."""
    words = F.split(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), r"[.,'’-]", " "), r"\s+")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*HONORIFICS, *GENERATIONS))


def bill_token(kind: Column, number: Column) -> Column:
    return F.concat(F.lower(kind), number.cast("int").cast("string"))


def bill_references(c: Column) -> Column:
    """Bills cited in a text as tokens such as hr1234, each once, in order of first mention.

    Dotted forms take no or one space before the number, plain ones exactly one; case counts; at most five digits.
    """
    dotted = "|".join(d.replace(".", r"\.") for _, d in BILL_FORMS)
    plain = "|".join(p for p, _ in BILL_FORMS)
    pattern = rf"\b(?:(?:{dotted})\s?|(?:{plain})\s)\d{{1,5}}\b"
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0))
    kind = lambda m: F.lower(F.regexp_replace(F.regexp_replace(m, r"\d+$", ""), r"[.\s]", ""))
    return F.array_distinct(F.transform(found, lambda m: bill_token(kind(m), F.regexp_extract(m, r"(\d+)$", 1))))


def last_match(c: Column, pattern: str, group: int = 1, keep: str = ".") -> Column:
    found = F.filter(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(group)), lambda x: x.rlike(keep))
    return F.try_element_at(found, F.lit(-1))


def asset_ticker(c: Column) -> Column:
    """The last symbol in parentheses that has a letter."""
    return last_match(c, r"\(([A-Z0-9.]{1,6})\)", keep="[A-Z]")


def house_asset_type(c: Column, ticker: Column) -> Column:
    """Kind of asset: the last two-letter code in brackets, else words, else a stock if there is a ticker."""
    code = last_match(c, r"\[([A-Z]{2})\]")
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in ASSET_CODES.items() for x in pair]), code)
    return F.coalesce(found, _named(c, ASSET_WORDS), F.when(ticker.isNotNull(), F.lit("stock")), F.lit("other"))


def _named(c: Column, patterns: tuple[tuple[str, str], ...]) -> Column:
    """The first name whose pattern the text holds."""
    return F.get(F.array_compact(F.array(*[F.when(c.rlike(pattern), F.lit(name)) for name, pattern in patterns])), F.lit(0))


def senate_asset_type(c: Column) -> Column:
    """Kind of asset from its words."""
    return F.coalesce(_named(F.lower(c), SENATE_ASSETS), F.lit("other"))


def senate_owner(c: Column) -> Column:
    return _named(F.lower(c), SENATE_OWNERS)


def senate_side(c: Column) -> Column:
    text = F.lower(c)
    return F.when(text.startswith("purchase"), "buy").when(text.startswith("sale"), "sell").when(text.startswith("exchange"), "exchange")


def house_side(c: Column) -> Column:
    """P, S or E, with "(partial)" or without (F16)."""
    letter = F.regexp_extract(F.upper(c), r"^\s*(?:\(\s*PARTIAL\s*\)\s*)?([A-Z])\s*(?:\(\s*PARTIAL\s*\)\s*)?$", 1)
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in HOUSE_SIDES.items() for x in pair]), letter)


def year_quarter(c: Column) -> Column:
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def is_weekend(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def hours_between(earlier: Column, later: Column) -> Column:
    return F.round((F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9), 1)


def short_ratio(short: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(short / total, 6))


def fingerprint(names: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of sorted names joined by bars."""
    return F.substring(F.sha2(F.concat_ws("|", F.array_sort(names)), 256), 1, 16)


def xml_escape(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def rfc822(c: Column) -> Column:
    return F.date_format(c, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")


def plain_number(c: Column) -> Column:
    """A number as text without a fraction of zero."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def shortened(c: Column, most: int = 140) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def link_id(c: Column) -> Column:
    """The path of a link without host, suffix .htm(l) and leading /newsevents/."""
    path = F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^https?://[^/]+", ""), r"(?i)\.html?$", "")
    return blank_to_null(F.regexp_replace(F.regexp_replace(path, "^/*", "/"), "^/(newsevents/)?", ""))


def congress_of(day: date) -> int:
    """The Congress that sits on a day: a new one each odd year from 3 January."""
    return (day.year - (1 if (day.month, day.day) < (1, 3) else 0) - 1789) // 2 + 1


def election_cycle(day: date) -> int:
    return day.year + day.year % 2


def quarters(since: date, until: date) -> list[tuple[int, int]]:
    """Calendar quarters that touch the days from ``since`` to ``until``."""
    found: list[tuple[int, int]] = []
    while since <= until:
        found.append((since.year, (since.month + 2) // 3))
        since = (since.replace(day=1, month=found[-1][1] * 3) + timedelta(days=31)).replace(day=1)
    return found
