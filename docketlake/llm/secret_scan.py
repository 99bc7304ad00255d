"""Secret scans over a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query: trigrams that any match must hold. The index is stored: a
copy of the texts in cells of CELL rows, and for each named trigram its postings, a bit mask of rows for each cell that
holds it. Intersecting postings (masks, bit by bit) leaves a rule's candidates, and only these are verified with the
expression itself, where their texts lie: candidates travel, texts do not. Rules without a mandatory trigram scan every
text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import read, scratch, written

#: Rows of a cell: one bit of a long each.
CELL_BITS = 6
#: Cells with candidates that are broadcast at a time (some 100 bytes each); more of them take several rounds.
BROADCAST_CELLS = 1 << 18


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match of ``pattern`` is dropped if ``group`` is shorter than ``least`` code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: Maximal runs shorter than the limit are no matches, so the limit of the second and third rule stands in the pattern.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{20,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("bearer", r"(?i:bearer)\x20+([A-Za-z0-9+/_.=~-]{20,})"),
)

#: Exact strings followed at a time while a query is derived; beyond this many the string is cut.
STRINGS = 24

#: A query is an OR of ANDs: sets of trigrams. The empty AND holds everywhere.
Query = frozenset[frozenset[str]]
ANY: Query = frozenset([frozenset()])


def _both(a: Query, b: Query) -> Query:
    """The AND of two queries; an alternative that another one implies is left out."""
    found = {x | y for x in a for y in b}
    return frozenset(x for x in found if not any(y < x for y in found))


def _strings(found: set[str]) -> Query:
    """Any of the strings must occur."""
    if not found or any(len(s) < 3 for s in found):
        return ANY
    alternatives = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in found}
    return frozenset(x for x in alternatives if not any(y < x for y in alternatives))


def _members(items: list) -> set[str] | None:
    """The characters of a class, in lower case, if they are few."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 6:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 6 else None


def _walk(tokens) -> tuple[set[str] | None, Query]:
    """The exact strings that a sequence matches (None: not known) and its query, in lower case."""
    query, current, whole = ANY, {""}, True

    def cut() -> None:
        nonlocal query, current, whole
        query, current, whole = _both(query, _strings(current)), {""}, False

    def add(strings: set[str] | None, its: Query = ANY) -> None:
        nonlocal current, query
        if strings is not None and len(strings) * len(current) <= STRINGS:
            current = {a + b for a in current for b in strings}
        else:
            cut()
            query = _both(query, its if strings is None else _strings(strings))

    for kind, value in tokens:
        if kind is op.LITERAL:
            add({chr(value).lower()})
        elif kind is op.IN:
            add(_members(value))
        elif kind is op.SUBPATTERN:
            add(*_walk(value[3]))
        elif kind is op.BRANCH:
            parts = [_walk(x) for x in value[1]]
            exact = [s for s, _ in parts]
            its = frozenset().union(*(_both(q, ANY if s is None else _strings(s)) for s, q in parts))
            add(None if None in exact else set().union(*exact), frozenset(x for x in its if not any(y < x for y in its)))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            least, most, inner = value
            strings, its = _walk(inner)
            if least == 0:
                add({"", *strings} if most == 1 and strings is not None else None)
            else:
                for _ in range(min(least, 3)):
                    add(strings, its)
                if most != least or least > 3:
                    cut()
        elif kind is not op.AT:
            cut()
    if whole:
        return current, query
    cut()
    return None, query


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that any match of the pattern holds, as an OR of ANDs; ANY if none is mandatory."""
    strings, query = _walk(parser.parse(pattern))
    return _both(query, ANY if strings is None else _strings(strings))


def named(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams that the rules' queries name."""
    return sorted({t for r in rules for alternative in trigram_query(r.pattern) for t in alternative})


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """``(trigram, cell, rows)``: for each named trigram and cell, the rows whose lower-case text holds it, as a mask."""
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(t)), F.lit(t)) for t in trigrams])) if trigrams else F.array().cast("array<string>")
    each = texts.select("cell", "bit", F.lower("text").alias("_low")).select("cell", "bit", F.explode(held).alias("trigram"))
    return each.groupBy("trigram", "cell").agg(F.bit_or("bit").alias("rows"))


@dataclass(frozen=True)
class Index:
    """A stored index: texts (cell, bit, doc_id, text), their postings, and the trigrams that have some."""

    texts: DataFrame
    postings: DataFrame
    trigrams: frozenset[str]

    @classmethod
    def build(cls, docs: DataFrame, path: str, trigrams: list[str] | None = None) -> Index:
        """Index ``docs`` under ``path``. Null text is empty; rows are told apart by place, so ids may repeat or be null."""
        spark, trigrams = docs.sparkSession, named(RULES) if trigrams is None else trigrams
        at = docs.select(F.monotonically_increasing_id().alias("_at"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        bit = F.expr(f"shiftleft(1L, cast(_at & {(1 << CELL_BITS) - 1} as int))")
        at.select(F.shiftright("_at", CELL_BITS).alias("cell"), bit.alias("bit"), "doc_id", "text").write.option("compression", "zstd").parquet(f"{path}/texts")
        spark.range(1).select(F.array(*[F.lit(t) for t in trigrams]).cast("array<string>").alias("trigrams")).write.parquet(f"{path}/trigrams")
        postings(spark.read.parquet(f"{path}/texts"), trigrams).sortWithinPartitions("trigram", "cell").write.parquet(f"{path}/postings")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Index:
        trigrams = spark.read.parquet(f"{path}/trigrams").first()[0]
        return cls(spark.read.parquet(f"{path}/texts"), spark.read.parquet(f"{path}/postings"), frozenset(trigrams))

    def candidates(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``(cell, masks)``: for each cell with a candidate, the rows that satisfy each rule's query, by the rules' order.

        The mask of a rule without mandatory trigrams is 0, as it asks for every row.
        """
        wanted = named(rules)
        if missing := sorted(set(wanted) - self.trigrams):
            raise ValueError(f"the index has no postings of {missing}")
        none = F.lit(0).cast("long")

        def mask(rule: Rule) -> Column:
            alternatives = sorted(map(sorted, trigram_query(rule.pattern)))
            if [] in alternatives:
                return none
            every = [reduce(Column.bitwiseAND, [F.col(f"t{wanted.index(t)}") for t in x]) for x in alternatives]
            return reduce(Column.bitwiseOR, every)

        if not wanted:
            return self.postings.where(F.lit(False)).select("cell", F.array(*[none for _ in rules]).alias("masks"))
        held = [F.coalesce(F.bit_or(F.when(F.col("trigram") == t, F.col("rows"))), none).alias(f"t{k}") for k, t in enumerate(wanted)]
        by_cell = self.postings.where(F.col("trigram").isin(wanted)).groupBy("cell").agg(*held)
        return by_cell.select("cell", F.array(*map(mask, rules)).alias("masks")).where(F.exists("masks", lambda m: m != 0))

    def scan(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Per row: doc_id, text and ``found``, the spans of all rules by start, then by the rules' order."""
        spark = self.texts.sparkSession
        met = written(self.candidates(rules), "candidate-cells")
        if met.count() <= BROADCAST_CELLS:
            return verified(self.texts, F.broadcast(met), rules)
        # a round takes files of the texts, whose rows lie in order, as long as their cells may be broadcast together
        files = self.texts.select("_metadata.file_path", "cell").groupBy("file_path").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"))
        here = F.shiftright("cell", 33 - CELL_BITS)  # the partition that wrote the row: at most as many as files
        cells = {r[0]: r[1] for r in met.groupBy(here).count().collect()}
        rounds: list[tuple[list[str], int, int, int]] = []
        for r in files.orderBy("lo").collect():
            n = cells.get(r.lo >> (33 - CELL_BITS), 0)
            if rounds and rounds[-1][3] + n <= BROADCAST_CELLS:
                paths, lo, _, before = rounds.pop()
                rounds.append(([*paths, r.file_path], lo, r.hi, before + n))
            else:
                rounds.append(([r.file_path], r.lo, r.hi, n))
        path = scratch(spark, "verified")
        for paths, lo, hi, n in rounds:
            part = met.where(F.col("cell").between(lo, hi))
            texts = spark.read.schema(self.texts.schema).parquet(*paths)
            verified(texts, F.broadcast(part) if n <= BROADCAST_CELLS else part, rules).write.mode("append").parquet(path)
        return spark.read.parquet(path)


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Matches of a rule as an array of (start, order, end): the texts between matches give the positions."""
    found, between = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    parts = F.transform(
        F.arrays_zip(found.alias("found"), between.alias("between"), checked.alias("checked")),
        lambda x: F.struct(F.length(x["between"]).alias("gap"), F.length(x["found"]).alias("size"), F.length(x["checked"]).alias("n")),
    )
    span = lambda start, end: F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["size"]
        kept = F.when(x["n"] >= rule.least, F.array_append(state["spans"], span(start, end))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    # the text after the last match has no partner among the matches and is left out
    return F.aggregate(F.filter(parts, lambda x: x["size"].isNotNull()), zero, step, lambda state: state["spans"])


def verified(texts: DataFrame, candidates: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The spans of each text's candidate rules, and of those rules that ask for every text."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = texts.join(candidates, "cell", "left")
    asked = lambda i: F.get("masks", F.lit(i)).bitwiseAND(F.col("bit")) != 0
    each = [spans(F.col("text"), r, i) if trigram_query(r.pattern) == ANY else F.when(asked(i), spans(F.col("text"), r, i)).otherwise(none) for i, r in enumerate(rules)]
    return joined.select("doc_id", "text", F.array_sort(F.concat(*each)).alias("found"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id, text and ``found``, the spans of all rules by start, then by the rules' order.

    Null text is empty; each row is verified on its own text, whether or not its doc_id repeats or is null; an empty
    table gives no rows. Only doc_id and text are read. The index is kept in the shared folder until ``discard``.
    """
    return Index.build(docs.select("doc_id", "text"), scratch(docs.sparkSession, "trigram-index"), named(rules)).scan(rules)


def listed(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, mask: str = "[secret]", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and text with each found span replaced by ``mask``; one that begins inside another only extends it."""
    found = scan(docs, rules)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        fresh = x["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, x["start"] - state["at"]), F.lit(mask))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    text = F.aggregate(F.col("found"), zero, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length(F.col("text")))))
    return found.select("doc_id", text.alias("text"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(read(spark, sf_dir, "documents"))
    base = [i for i, r in enumerate(RULES) if r.base]
    count = lambda i: F.size(F.filter("found", lambda x: x["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.filter("found", lambda x: x["kind"] <= max(base))).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    """Positions from the texts between matches, as in spans(); RE2 wants no possessive or look-around forms, and has none here."""
    each = []
    for order, r in enumerate(RULES):
        pattern = r.pattern.replace("'", "''")
        found, between = f"regexp_extract_all(t, '{pattern}')", f"string_split_regex(t, '{pattern}')"
        checked = f"regexp_extract_all(t, '{pattern}', {r.group})"
        each.append(f"SELECT doc_id, {order} AS k, '{r.kind}' AS kind, {r.least} AS least, {found} AS m, {between} AS g, {checked} AS c FROM d")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS ({' UNION ALL '.join(each)}),
p AS (SELECT doc_id, k, kind, least, m, g, c, unnest(range(1, len(m) + 1)) AS i FROM a),
s AS (
    SELECT doc_id, k, kind, length(m[i]) AS size, length(c[i]) AS n, least,
        coalesce(list_sum(list_transform(g[:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS start FROM p
), f AS (
    SELECT doc_id, k, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT) AS span FROM s WHERE n >= least
), h AS (
    SELECT doc_id, count(*) FILTER (k = 0) AS a0, count(*) FILTER (k = 1) AS a1, count(*) FILTER (k = 2) AS a2, string_agg(span, ',' ORDER BY start, k) AS spans, string_agg(span, ',' ORDER BY start, k) FILTER (k <= 2) AS base
    FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a0, 0) AS n_assign, coalesce(a1, 0) AS n_access, coalesce(a2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN h ON d.doc_id = h.doc_id
"""


ORACLE = _oracle()
