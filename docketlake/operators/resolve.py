"""Names to tickers and members (J11, J12, H8). Distinct names are resolved once and joined back; every step is an
equi-join, the word-boundary prefix included, and an ambiguous match resolves to nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.functions import scalars as S
from docketlake.operators.aggregates import name_index


def curated_index(entries: DataFrame) -> DataFrame:
    """(entry, name, tickers) from curated entries (entry, names, tickers); a name in two entries is an error (H8)."""
    rows = entries.select("entry", F.explode("names").alias("raw"), "tickers").select("entry", S.entity_name(F.col("raw")).alias("name"), "tickers").where("name != ''")
    clash = rows.groupBy("name").agg(F.count_distinct("entry").alias("n")).where("n > 1").select("name").limit(5).collect()
    if clash:
        raise ValueError(f"names of several entries: {', '.join(r['name'] for r in clash)}")
    return rows.dropDuplicates(["name"])


def _prefixes(name: Column) -> Column:
    """Proper prefixes of two words or more that end at a word."""
    words = F.split(name, " ")
    return F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(words) - 1)), lambda n: F.array_join(F.slice(words, 1, n), " "))


def resolve_entities(names: DataFrame, entries: DataFrame, ueis: DataFrame | None = None, registrants: DataFrame | None = None) -> DataFrame:
    """(name, tickers) for each distinct name: by UEI, by exact name, by the one curated entry whose name of several
    words begins it, by the exact name of one registrant; else no ticker (J11).

    ``names`` has name and, with ``ueis`` (uei, tickers), uei. A single word never matches as a prefix.
    """
    asked = names.select("name", *(["uei"] if ueis is not None else [])).where("name is not null").distinct()
    keyed = asked.withColumn("_n", S.entity_name(F.trim("name")))
    index = curated_index(entries)
    found = keyed.join(index.select(F.col("name").alias("_n"), F.col("tickers").alias("_exact")), "_n", "left")
    long = index.where(F.contains("name", F.lit(" "))).select(F.col("name").alias("_prefix"), "entry", F.col("tickers").alias("_t"))
    begun = keyed.select("_n").distinct().where(F.size(F.split("_n", " ")) > 2).select("_n", F.explode(_prefixes(F.col("_n"))).alias("_prefix")).join(long, "_prefix")
    only = begun.groupBy("_n").agg(F.count_distinct("entry").alias("_e"), F.first("_t").alias("_begun")).where("_e = 1").drop("_e")
    steps = ["_exact", "_begun"]
    found = found.join(only, "_n", "left")
    if ueis is not None:
        found = found.join(ueis.select(F.upper(F.trim("uei")).alias("_u"), F.col("tickers").alias("_uei")), F.upper(F.trim(found["uei"])) == F.col("_u"), "left").drop("_u")
        steps = ["_uei", *steps]
    if registrants is not None:
        found = found.join(name_index(registrants).select(F.col("name").alias("_n"), F.col("tickers").alias("_sec")), "_n", "left")
        steps = [*steps, "_sec"]
    return found.select("name", *(["uei"] if ueis is not None else []), F.coalesce(*steps, F.array().cast("array<string>")).alias("tickers"))


def match_members(filed: DataFrame, members: DataFrame) -> DataFrame:
    """(name, chamber, bioguide_id) for each distinct filed name.

    "Last, First" needs the whole last name; otherwise a member's last name must end the filed name. Several candidates
    are told apart by the first name, which may be short for the other; still several, or none, give null.
    ``members``: (bioguide_id, first_name, last_name, chamber).
    """
    asked = filed.select("name", "chamber").distinct()
    comma = F.contains("name", F.lit(","))
    before, after = F.get(F.split("name", ",", -1), F.lit(0)), F.get(F.split("name", ",", -1), F.lit(1))
    tokens = S.name_tokens(F.when(comma, before).otherwise(F.col("name")))
    rows = asked.select("name", "chamber", comma.alias("_comma"), tokens.alias("_t"), S.name_tokens(F.when(comma, after)).alias("_f"))
    # how many words of the filed name stand before the last name: none behind a comma, else any number
    starts = F.when(F.col("_comma"), F.array(F.lit(1))).otherwise(F.sequence(F.lit(1), F.greatest(F.size("_t"), F.lit(1))))
    tails = rows.where(F.size("_t") > 0).withColumn("_s", F.explode(starts))
    keyed = tails.select("name", "chamber", F.array_join(F.slice(F.col("_t"), F.col("_s"), F.size("_t")), " ").alias("_last"), F.coalesce(F.when(F.col("_comma"), F.get("_f", F.lit(0))).when(F.col("_s") > 1, F.get("_t", F.lit(0))), F.lit("")).alias("_first"))
    known = members.select("bioguide_id", "chamber", F.array_join(S.name_tokens(F.col("last_name")), " ").alias("_last"), F.coalesce(F.get(S.name_tokens(F.col("first_name")), F.lit(0)), F.lit("")).alias("_own")).where("_last != ''")
    agree = (F.col("_first") != "") & (F.col("_own") != "") & (F.col("_own").startswith(F.col("_first")) | F.col("_first").startswith(F.col("_own")))
    hits = keyed.join(known, ["_last", "chamber"]).groupBy("name", "chamber").agg(
        F.count("*").alias("n"), F.min("bioguide_id").alias("one"), F.count_if(agree).alias("agreeing"), F.min(F.when(agree, F.col("bioguide_id"))).alias("narrowed")
    )
    chosen = F.when(F.col("n") == 1, F.col("one")).when(F.col("agreeing") == 1, F.col("narrowed"))
    return asked.join(hits.select("name", "chamber", chosen.alias("bioguide_id")), ["name", "chamber"], "left")
