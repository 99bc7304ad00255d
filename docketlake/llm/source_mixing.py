"""Mixing sources to target weights.

Tokens (words) are summed by source, the sums and the weights give each source's target and so its repetition rate, and
each document is emitted floor(rate) times plus one copy drawn by a hash of its id with probability equal to the
fraction. The draw depends on the id and the seed alone, so reruns and retried tasks agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketlake.llm.common import BROADCAST_ROWS, WORD, read, word_count, written

#: Weights of sources in order of code points, repeating; null comes last.
WEIGHTS = (3, 1, 2)
#: The mix holds this share of all words, and no source more than this multiple of its own.
SHARE, MOST = 1.5, 2.0
SEED = "mix-1"
#: Broadcast source names hold at most this many characters in all.
BROADCAST_CHARS = 4_000_000


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from rows of ``(source, size)``.

    Targets are in proportion to the weights, except that a source stops at ``most`` times its size and the rest is
    shared again: sources are put in order of size by weight, and the first whose share does not exceed its limit tells
    the level for all after it. A source without words has target 0, and so have all if there are no words at all.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.select("*", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("_rank"))
    weighted = ranked.select("*", F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights)).cast("int") + 1).cast("long").alias("_w"))
    order = Window.orderBy(F.col("source_size") / F.col("_w"), "_rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (share * total - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("_w").over(after)
    levelled = weighted.select("*", level.alias("_level"), F.row_number().over(order).alias("_at"))
    free = F.col("_level") * F.col("_w") <= most * F.col("source_size")
    common = F.min(F.when(free, F.struct("_at", "_level"))).over(Window.partitionBy())["_level"]
    target = F.when(free, common * F.col("_w")).otherwise(most * F.col("source_size"))
    return levelled.select("source", "source_size", target.cast("double").alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the id and the seed; a null id draws as the text ``null``."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 52)


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    return (F.floor(rate) + F.when(draw(doc_id, seed) < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def join_sources(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Add ``source_size`` and ``target`` by column ``source`` (null equals null).

    A source table of checked size is broadcast; a larger one is spread by salt, as one source may hold most rows.
    """
    size = found.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("source")), F.lit(0)).alias("c")).first()
    names = found.select(F.col("source").alias("_source"), "source_size", "target")
    if size["n"] <= BROADCAST_ROWS and size["c"] <= BROADCAST_CHARS:
        return rows.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    salts = 16
    spread = names.select("*", F.explode(F.array(*map(F.lit, range(salts)))).alias("_salt"))
    salted = rows.select("*", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("_row_salt"))
    return salted.join(spread, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_row_salt") == F.col("_salt"))).drop("_source", "_salt", "_row_salt")


def measured(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")


def mixture(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies and taken (size times copies).

    Null text has size 0; null sources are one source; repeated rows draw alike; an empty table gives no rows. Only
    doc_id, source and text are read.
    """
    rows = measured(docs)
    found = written(targets(rows), "mix-targets")
    joined = join_sources(rows, found)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return joined.select("doc_id", "size", "source_size", "target", copies(rate, F.col("doc_id"), seed).alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: rows of ``docs``, all columns, each as often as it is taken."""
    found = written(targets(docs.select("source", word_count(F.col("text")).alias("size"))), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "source", "doc_id")
    return join_sources(whole, found).select("_row", F.explode(F.array_repeat(F.lit(1), copies(rate, F.col("doc_id"), seed)))).select("_row.*")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), r AS (
    SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k FROM s
), w AS (
    SELECT *, CASE k % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS wt FROM r
), l AS (
    SELECT *, row_number() OVER o AS pos,
        ({SHARE}::DOUBLE * (sum(source_size) OVER ())::DOUBLE
            - {MOST}::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / wt, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(wt) OVER (ORDER BY source_size / wt, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM w WINDOW o AS (ORDER BY source_size / wt, k)
), t AS (
    SELECT source, source_size, CASE WHEN level * wt <= {MOST}::DOUBLE * source_size
        THEN (SELECT arg_min(level, pos) FROM l WHERE level * wt <= {MOST}::DOUBLE * source_size) * wt ELSE {MOST}::DOUBLE * source_size END AS target
    FROM l
), j AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0::DOUBLE AS u
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM j
"""
