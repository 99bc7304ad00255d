"""Joins of several tables (J2-J8, J13-J16), entity search (A9) and series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketlake.operators.filters import clamp, contains, order, top_groups, where


def period_change(df: DataFrame, keys: Sequence[str], names: Sequence[str], period: str, shares: str, value: str, at=None) -> DataFrame:
    """Positions of a period beside the shares of the period before it.

    The period is ``at`` or the latest; the prior one is the latest before it. A period ``at`` without rows has no
    positions. Keys compare with null equal to null. One pass sums both periods by key, and the sides meet by a
    null-safe equi-join.
    """
    dated = df.where(F.col(period).isNotNull())
    until = dated if at is None else dated.where(F.col(period) <= F.lit(at).cast("date"))
    two = [r[0] for r in until.select(period).distinct().orderBy(F.col(period).desc()).limit(2).collect()]  # two dates
    if at is not None and two and str(two[0])[:10] != str(at)[:10]:
        two = []
    exact = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    now = dated.where(F.col(period) == (F.lit(two[0]) if two else F.lit(None)))
    current = now.groupBy(*keys, *names, period).agg(exact(shares).alias("shares"), exact(value).alias("value_usd"))
    before = dated.where(F.col(period) == (F.lit(two[1]) if len(two) > 1 else F.lit(None)))
    prior = before.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(exact(shares).alias("shares_prior"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = current.join(prior, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn("shares_change", F.col("shares") - F.col("shares_prior")).withColumnRenamed(period, "period_end")


def manager_holdings(df: DataFrame, needle: str, identity: Sequence[str], period: str, by: Sequence[str], limit: int | None = None) -> DataFrame:
    """The holdings, in their latest period, of the best match: the identity with most rows whose name contains the needle."""
    best = top_groups(where(df, contains(identity[-1], needle)), identity, [F.count("*").alias("_n")], ["-_n"], 1).select(identity[0])
    own = df.join(F.broadcast(best), identity[0], "left_semi")  # one row
    latest = own.agg(F.max(period).alias("_latest"))
    return own.join(F.broadcast(latest), F.col(period) == F.col("_latest")).drop("_latest").orderBy(*order(*by)).limit(clamp(limit))


def roster(seats: DataFrame, trades: DataFrame, keys: Sequence[str], member: str, rank: Column, title: Column, date: str) -> DataFrame:
    """Seats folded by member beside the member's trades, none counting 0 (J3, A16). Trades are summed before the join."""
    activity = trades.groupBy(member).agg(F.count("*").alias("trades"), F.max(date).alias("last_date"))
    folded = seats.groupBy(*keys).agg(rank, title)
    return folded.join(activity, member, "left").withColumn("trades", F.coalesce("trades", F.lit(0)))


def fold_committees(seats: DataFrame) -> DataFrame:
    """Seats of a member by committee: title of the main seat, names of the subcommittees in order."""
    subs = F.array_sort(F.collect_set("subcommittee_name"))
    title = F.max(F.when(F.col("subcommittee_thomas_id").isNull(), F.col("title")))
    return seats.groupBy("bioguide_id", "committee_thomas_id", "committee_name").agg(title.alias("title"), subs.alias("subcommittees"))


def row_index(df: DataFrame, keys: Sequence[str], by: Sequence[str], name: str = "idx") -> DataFrame:
    """The place of each row within its group, from 0."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order(*by))) - 1)


def group_fill(df: DataFrame, keys: Sequence[str], by: Sequence[str], starts: Column, name: str = "grp") -> DataFrame:
    """Number of the group that each row belongs to, counting rows that start one; rows before the first have 0."""
    running = Window.partitionBy(*keys).orderBy(*order(*by)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(running))


def insider_rows(entries: DataFrame, submissions: DataFrame, owners: DataFrame) -> DataFrame:
    """Quarterly insider tables assembled (J6): entries with their submission and first owner.

    Entries have accession, derivative (bool), kind (transaction or holding) and sk; the index counts transactions
    before holdings, by sk, within each accession and table. Entries without submission or owner are left out.
    """
    first = owners.groupBy("accession").agg(F.min_by(F.struct(*[c for c in owners.columns if c not in ("accession", "owner_seq")]), "owner_seq").alias("owner"), F.count("*").alias("_owners"))
    placed = row_index(entries.withColumn("_holding", F.col("kind") == "holding"), ["accession", "derivative"], ["_holding", "sk"])
    joined = placed.join(submissions, "accession").join(first, "accession")
    key = F.concat_ws(":", "accession", F.when(F.col("derivative"), "d").otherwise("nd"), F.col("idx").cast("string"))
    return joined.select(key.alias("id"), "*", (F.col("_owners") > 1).alias("needs_review")).drop("_owners", "_holding")


def patents_joined(patents: DataFrame, assignees: DataFrame, classes: DataFrame) -> DataFrame:
    """Patents beside the number of assignees, the first organisation and the first class by sequence."""
    from docketlake.operators.aggregates import first_by_sequence

    org = first_by_sequence(assignees, "patent_id", "assignee_sequence", "organization", F.trim("organization") != "", "assignee_count").withColumnRenamed("first", "assignee_name")
    cpc = first_by_sequence(classes, "patent_id", "cpc_sequence", "cpc_class", F.trim("cpc_class") != "").select("patent_id", F.upper(F.trim("first")).alias("cpc_class"))
    joined = patents.join(org, "patent_id", "left").join(cpc, "patent_id", "left")
    return joined.withColumn("assignee_count", F.coalesce("assignee_count", F.lit(0)))


def entity_search(kinds: dict[str, tuple[DataFrame, DataFrame, str, str]], needle: str) -> DataFrame:
    """Names that contain the needle, with the rows that refer to them, by kind; names without rows are left out.

    ``kinds`` maps a kind to (entities with their key and name, rows, key of entities, key of rows). Matching names are
    few, so that rows are filtered by a semi-join before they are counted.
    """

    def one(kind: str, entities: DataFrame, rows: DataFrame, key: str, foreign: str) -> DataFrame:
        found = where(entities, contains("name", needle))
        counted = rows.join(found.select(F.col(key).alias(foreign)).distinct(), foreign, "left_semi").groupBy(F.col(foreign).alias(key)).agg(F.count("*").alias("n"))
        return found.join(counted, key).groupBy(F.lit(kind).alias("kind"), "name").agg(F.sum("n").alias("n"))

    return reduce(DataFrame.unionByName, [one(kind, *spec) for kind, spec in kinds.items()])


def ticker_counts(datasets: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(ticker, dataset, rows) over all datasets with a ticker column or array: one long table in place of a query each."""

    def one(name: str, df: DataFrame, tickers: Column) -> DataFrame:
        return df.select(F.explode(tickers).alias("ticker")).where("ticker is not null").groupBy("ticker").agg(F.count("*").alias("rows")).withColumn("dataset", F.lit(name))

    return reduce(DataFrame.unionByName, [one(name, *spec) for name, spec in datasets.items()]).select("ticker", "dataset", "rows")


def bill_lobbying(bills: DataFrame, filings: DataFrame, limit: int = 20) -> DataFrame:
    """Lobbying filings that cite a bill, by its token, whatever the Congress."""
    token = F.concat(F.lower("bill_type"), F.col("bill_number").cast("string"))
    cited = filings.withColumn("_token", F.explode("bill_references"))
    found = bills.select(token.alias("_token"), F.col("id").alias("bill_id")).join(cited, "_token").drop("_token")
    place = F.row_number().over(Window.partitionBy("bill_id").orderBy(*order("-filing_year", "id")))
    return found.withColumn("_at", place).where(F.col("_at") <= limit).drop("_at")  # the bound holds before the shuffle, too


def candidate_contributions(candidates: DataFrame, contributions: DataFrame) -> DataFrame:
    """All contributions of the one candidate among the matches; none if there are several (J14). Limits come after."""
    only = candidates.agg(F.count_distinct("candidate_id").alias("_n"), F.min("candidate_id").alias("candidate_id")).where("_n = 1").select("candidate_id")
    return contributions.join(F.broadcast(only), "candidate_id", "left_semi")  # at most one row


def oversight_overlap(seats: DataFrame, trades: DataFrame, awards: DataFrame) -> DataFrame:
    """Trades of committee members in companies that were awarded contracts, with the days between."""
    members = seats.select("bioguide_id", "committee_thomas_id").distinct()
    own = trades.where("ticker is not null").join(members, "bioguide_id")
    exploded = awards.select(F.col("id").alias("award_id"), "action_date", "agency", F.explode("recipient_tickers").alias("ticker"))
    return own.join(exploded, "ticker").withColumn("days_after_award", F.datediff("transacted_at", "action_date"))


def gap_filled(df: DataFrame, keys: Sequence[str], date: str, since: str, until: str, weekdays_only: bool = False) -> DataFrame:
    """Rows by key and day, days without any counting 0 (F4, F5). The days are a literal sequence, so nothing is crossed."""
    spine = F.explode(F.sequence(F.lit(since).cast("date"), F.lit(until).cast("date")))
    days = df.select(*keys).distinct().select(*keys, spine.alias(date))
    if weekdays_only:
        days = days.where(~F.dayofweek(date).isin(1, 7))
    return days.join(df.groupBy(*keys, date).agg(F.count("*").alias("n")), [*keys, date], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def set_sizes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Sizes of the intersection, the difference, the union and the concatenation of two sets of rows."""
    size = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return size("both", a.intersect(b)).unionByName(size("first only", a.exceptAll(b))).unionByName(size("union", a.union(b).distinct())).unionByName(size("all", a.unionAll(b)))
