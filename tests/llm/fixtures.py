"""A small corpus with the hard cases: nulls, empties, ties, repeats, long texts, odd white space and clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession


def corpus() -> list[tuple]:
    rnd = random.Random(7)
    words = [a + b for a in ("ta", "re", "mi", "so", "lu", "ve") for b in ("n", "r", "st", "la", "do", "ki", "pe")]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = prose(70)
    rows: list[tuple] = []
    base = [prose(rnd.randint(60, 200)) for _ in range(30)]
    for i, text in enumerate(base):
        rows.append((i, text, f"s{i % 3}"))
    for i in range(8):  # near copies: one word in forty replaced
        parts = base[i].split(" ")
        parts[rnd.randrange(len(parts))] = "edited"
        rows.append((100 + i, " ".join(parts), "s0"))
    for i in range(12):  # exact copies
        rows.append((200 + i, base[3], "s0"))
    for i in range(6):  # a shared passage
        rows.append((300 + i, prose(40) + "\n" + passage + " " + prose(30), "s1"))
    rows += [
        (400, None, None), (401, "", "s2"), (402, " \t\n\x0b\x0c\r ", "s2"), (403, "one", "s2"), (404, "two words", None), (405, "a b c d", "s1"),
        (406, "same " * 300, "s1"), (407, prose(9000), "s2"), (408, "lié é́ ﬁ  x y 日本語 😀😀 " + prose(60), "s2"), (409, "x\x0by\x0cz\r\nw\x85v " + prose(55), "s2"),
        (410, "AAA!! BBB!! CCC!! " * 60, "s1"), (411, "%%% *** ### " + " ".join(f"{w}###" for w in prose(80).split()), "s1"), (412, "line one of text\n" * 40, "s1"),
        (None, prose(80), "s1"), (None, prose(80), "s1"), (5, base[5], "s2"), (6, prose(90), "s0"), (6, prose(90), "s0"),
    ]
    return rows


def frame(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    """The corpus with columns whose names the operators use themselves."""
    rows = corpus() if rows is None else rows
    extra = [(*r, 1.5, "x", 7) for r in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, source string, score double, kept string, n_words int").repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return frame(spark, [])
