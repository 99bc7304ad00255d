"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes *good* (1), *bad* (-1) or abstains (0). The rows of the vote table are counted by vote pattern (at
most three to the power of the number of rules, whatever the corpus), expectation-maximisation over the counted patterns
estimates each rule's vote rates in either class, and the posterior probability of *good* decides instead of all rules
having to pass: a single bad vote of a rule that others seldom confirm is outweighed, one that they confirm is not. So
that rules can confirm each other, what is measured is judged at two severities where that makes sense.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm.common import WORD, bind, read, words, written

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: Low bits of a packed window that hold its position; longer texts sort pairs instead of packed numbers.
POSITION_BITS = 20

#: Documents believed in before any is counted, as a share of the corpus, so that estimation behaves alike at every size;
#: the rates of votes on (good, bad) documents that they stand for, and their share of good documents.
BELIEF, BELIEVED, GOOD = 0.05, {1: (0.6, 0.3), -1: (0.01, 0.3)}, 0.8
#: Bounds of the share of good documents, far from what is estimated on real tables.
PRIOR = (0.5, 0.98)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marks", "n_distinct")


def _rate(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)



def rules() -> dict[str, Column]:
    """Votes by rule name (a function, as columns need a running session)."""
    symbols, repeats = _rate("n_symbols", "n_words"), _rate("n_repeat_words", "n_words")
    lines, length = _rate("n_dup_lines", "n_lines"), _rate("word_chars", "n_words")
    upper, marks, distinct = _rate("n_upper", "n_letters"), _rate("n_marks", "n_words"), _rate("n_distinct", "n_words")
    return {
        "symbols": _vote(symbols > 0.1, symbols <= 0.02),
        "symbol_flood": _vote(symbols > 0.3, symbols <= 0.1),
        "repeats": _vote(repeats > 0.2, repeats <= 0.05),
        "repeat_flood": _vote(repeats > 0.45, repeats <= 0.2),
        "lines": _vote(lines > 0.1, (F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3)),
        "line_flood": _vote((lines > 0.3) & (F.col("n_dup_lines") >= 3), lines <= 0.1),
        "capitals": _vote(upper > 0.3, upper.between(0.002, 0.1)),
        "marks": _vote(marks > 0.1, marks <= 0.02),
        "length": _vote((length < 3) | (length > 10), length.between(4, 7)),
        "variety": _vote((distinct < 0.3) & (F.col("n_words") < 2000), distinct >= 0.45),
    }


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that the text holds twice or more.

    Packed (hash, position) numbers are sorted; windows that share the hash bits with a neighbour are few, and only
    those are compared as strings, so that a clash of hashes changes nothing.
    """
    gram = lambda w, i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    low = (1 << POSITION_BITS) - 1
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - 3)
    packed = lambda w: F.sort_array(
        F.transform(starts(w), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    )

    def twins(s: Column) -> Column:
        top = lambda x: F.shiftright(x, POSITION_BITS)
        same = lambda x, k: F.coalesce(top(x) == top(F.get(s, k)), F.lit(False))
        return F.transform(F.filter(s, lambda x, k: same(x, k + 1) | same(x, k - 1)), lambda x: x.bitwiseAND(F.lit(low)).cast("int"))

    def repeated(w: Column, candidates: Column) -> Column:
        """Start positions, ascending, of windows whose words occur again among the candidates."""
        pairs = F.array_sort(F.transform(candidates, lambda i: F.struct(gram(w, i).alias("g"), i.alias("i"))))
        equal = lambda x, s, k: F.coalesce(x["g"] == F.get(s, k)["g"], F.lit(False))
        return bind(pairs, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: equal(x, s, k + 1) | equal(x, s, k - 1)), lambda x: x["i"])))

    def covered(r: Column) -> Column:
        gaps = F.transform(r, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(r, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def of(w: Column) -> Column:
        candidates = F.when(F.size(w) - 2 <= low, bind(packed(w), twins)).otherwise(starts(w))
        return bind(bind(candidates, lambda c: repeated(w, c)), covered)

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(of(w))


def measures(text: Column) -> list[Column]:
    """The measures of a text, as columns named in MEASURES; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    count = lambda chars: (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
    letters = "abcdefghijklmnopqrstuvwxyz"
    with_word = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    packed = bind(
        words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct")),
    )
    lines = bind(with_word, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return [
        packed.alias("_w"),
        lines.alias("_l"),
        (F.length(F.translate(text, SPACES, ""))).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(letters.upper()).alias("n_upper"),
        count(letters + letters.upper()).alias("n_letters"),
        count("!|").alias("n_marks"),
    ]


def measured(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """One row of measures for each document; ``carry`` goes along as column ``_row``."""
    kept = [F.col("doc_id")] if carry is None else [carry.alias("_row")]
    flat = docs.select(*kept, *measures(F.col("text")))
    first = ["doc_id"] if carry is None else ["_row"]
    return flat.select(
        *first, "_w.n_words", "word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words", "_l.n_lines", "n_upper", "n_letters", "n_marks", "_w.n_distinct"
    )


@dataclass(frozen=True)
class VoteModel:
    """Prior of *good*, and log odds of good against bad by rule and vote."""

    prior: float
    log_odds: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """The posterior probability of *good* from the vote columns (``vote_<rule>``)."""
        total: Column = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, by_vote in self.log_odds.items():
            vote = F.col(f"vote_{name}")
            total = total + F.when(vote == 1, by_vote[1]).when(vote == -1, by_vote[-1]).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = 25) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.

    The first expectation takes documents with a bad vote as bad, and others as good, with nine in ten certainty. Then
    each rule's rates of good and bad votes in either class, and the share of good documents, follow from the
    posteriors, and these from the rates; an abstention speaks for neither class. Each rate and the share also count
    BELIEF times the corpus of documents as believed beforehand, which keeps a rule finite that never votes one way. No
    pattern at all (an empty corpus) gives the prior's upper bound and odds of one.
    """
    low, high = PRIOR
    total = sum(n for _, n in patterns)
    believed = BELIEF * total
    posterior = [0.1 if -1 in votes else 0.9 for votes, _ in patterns]
    prior, odds = high, [{1: 0.0, -1: 0.0} for _ in names]
    for _ in range(rounds if patterns else 0):
        mass = [sum(p * n for p, (_, n) in zip(posterior, patterns, strict=True))]
        mass.append(total - mass[0])
        for j in range(len(names)):
            rate = {}
            for v, before in BELIEVED.items():
                cast = [sum(q * n for q, (votes, n) in zip(side, patterns, strict=True) if votes[j] == v) for side in (posterior, [1 - p for p in posterior])]
                rate[v] = [(c + e * believed) / (m + believed) for c, e, m in zip(cast, before, mass, strict=True)]
            odds[j] = {v: math.log(good / bad) for v, (good, bad) in rate.items()}
        prior = min(high, max(low, (mass[0] + GOOD * believed) / (total + believed)))
        posterior = [1 / (1 + math.exp(-max(-500.0, min(500.0, math.log(prior / (1 - prior)) + sum(odds[j][v] for j, v in enumerate(votes) if v))))) for votes, _ in patterns]
    return VoteModel(prior, dict(zip(names, odds, strict=True)))


def judge(docs: DataFrame, threshold: float = 0.5, rows: bool = False) -> DataFrame:
    """Measures, votes, ``quality`` (posterior of good), ``base_failed`` and ``kept`` for each row of ``docs``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated 3-word windows. ``kept`` is false for
    those and otherwise tells whether ``quality`` reaches ``threshold``. Null text counts as empty; a null doc_id and
    repeated rows give a row each; an empty table gives an empty result. Only doc_id and text are read, so other columns
    may have any name; ``rows=True`` returns them, whole, in struct ``_row`` in place of doc_id.
    """
    votes = rules()
    names = list(votes)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    table = written(measured(docs, F.struct(*cols) if rows else None), "quality-measures")
    voted = table.select("*", *[v.cast("int").alias(f"vote_{n}") for n, v in votes.items()])
    counted = voted.groupBy(*[f"vote_{n}" for n in names]).count().collect()  # at most 3 ** rules rows
    model = estimate(sorted((tuple(r[:-1]), r[-1]) for r in counted), names)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return voted.withColumn("base_failed", failed).withColumn("quality", model.posterior()).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def filter_rejected(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    return judge(docs, threshold, rows=True).where("kept").select("_row.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"), *[c for c in found.columns if c.startswith("vote_")])


def _oracle(rounds: int = 25) -> str:
    """The measures, the votes and the rounds of expectation-maximisation, a pair of common tables for each round."""
    votes = {
        "symbols": "CASE WHEN symbols > 0.1 THEN -1 WHEN symbols <= 0.02 THEN 1 ELSE 0 END",
        "symbol_flood": "CASE WHEN symbols > 0.3 THEN -1 WHEN symbols <= 0.1 THEN 1 ELSE 0 END",
        "repeats": "CASE WHEN repeats > 0.2 THEN -1 WHEN repeats <= 0.05 THEN 1 ELSE 0 END",
        "repeat_flood": "CASE WHEN repeats > 0.45 THEN -1 WHEN repeats <= 0.2 THEN 1 ELSE 0 END",
        "lines": "CASE WHEN lines > 0.1 THEN -1 WHEN n_dup_lines = 0 AND n_lines >= 3 THEN 1 ELSE 0 END",
        "line_flood": "CASE WHEN lines > 0.3 AND n_dup_lines >= 3 THEN -1 WHEN lines <= 0.1 THEN 1 ELSE 0 END",
        "capitals": "CASE WHEN capitals > 0.3 THEN -1 WHEN capitals BETWEEN 0.002 AND 0.1 THEN 1 ELSE 0 END",
        "marks": "CASE WHEN marks > 0.1 THEN -1 WHEN marks <= 0.02 THEN 1 ELSE 0 END",
        "length": "CASE WHEN length < 3 OR length > 10 THEN -1 WHEN length BETWEEN 4 AND 7 THEN 1 ELSE 0 END",
        "variety": "CASE WHEN variety < 0.3 AND n_words < 2000 THEN -1 WHEN variety >= 0.45 THEN 1 ELSE 0 END",
    }
    names, (low, high) = list(votes), PRIOR
    any_bad = " OR ".join(f"vote_{n} = -1" for n in names)
    steps = [f"p0 AS MATERIALIZED (SELECT *, CASE WHEN {any_bad} THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END AS p FROM pat)"]
    mass = lambda weight, where: f"coalesce((sum({weight} * n) FILTER ({where}))::DOUBLE, 0)"
    for k in range(rounds):
        rates, odds = [f"{BELIEF} * sum(n)::DOUBLE AS believed", "sum(n)::DOUBLE AS total", "sum(p * n)::DOUBLE AS good"], []
        for n in names:
            rates += [f"{mass(w, f'vote_{n} = {v}')} AS {n}_{tag}" for w, v, tag in (("p", -1, "gd"), ("p", 1, "gu"), ("(1 - p)", -1, "bd"), ("(1 - p)", 1, "bu"))]
            for v, tag in ((1, "u"), (-1, "d")):
                good, bad = (f"(({n}_{c}{tag} + {before} * believed) / ({whole} + believed))" for c, before, whole in zip("gb", BELIEVED[v], ("good", "(total - good)"), strict=True))
                odds.append(f"ln({good} / {bad}) AS {n}_{'up' if v == 1 else 'down'}")
        prior = f"least({high}, greatest({low}, (good + {GOOD} * believed) / (total + believed)))::DOUBLE AS prior"
        steps.append(f"m{k + 1} AS MATERIALIZED (SELECT {prior}, {', '.join(odds)} FROM (SELECT {', '.join(rates)} FROM p{k}))")
        sums = " + ".join(f"CASE vote_{n} WHEN 1 THEN {n}_up WHEN -1 THEN {n}_down ELSE 0 END" for n in names)
        columns = ", ".join([*[f"vote_{n}" for n in names], "n"])
        steps.append(f"p{k + 1} AS MATERIALIZED (SELECT {columns}, 1 / (1 + exp(-(ln(prior / (1 - prior)) + {sums}))) AS p FROM p{k}, m{k + 1})")
    same = " AND ".join(f"v.vote_{n} = q.vote_{n}" for n in names)
    rate = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END"
    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM documents
), g AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), o AS (
    SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1
), r AS (
    SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 3)) AS j FROM o) GROUP BY doc_id
), f AS (
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
        length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^!|]', '', 'g')) AS n_marks, len(list_distinct(ws)) AS n_distinct
    FROM d LEFT JOIN r ON d.doc_id = r.doc_id
), x AS (
    SELECT *, {rate('n_symbols', 'n_words')} AS symbols, {rate('n_repeat_words', 'n_words')} AS repeats, {rate('n_dup_lines', 'n_lines')} AS lines, {rate('word_chars', 'n_words')} AS length,
        {rate('n_upper', 'n_letters')} AS capitals, {rate('n_marks', 'n_words')} AS marks, {rate('n_distinct', 'n_words')} AS variety FROM f
), v AS (
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {', '.join(f'{sql} AS vote_{n}' for n, sql in votes.items())} FROM x
), pat AS MATERIALIZED (
    SELECT {', '.join(f'vote_{n}' for n in names)}, count(*) AS n FROM v GROUP BY ALL
), {', '.join(steps)}
SELECT v.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND q.p >= 0.5 AS kept, round(q.p, 6) AS quality
FROM v JOIN p{rounds} q ON {same}
"""


ORACLE = _oracle()
