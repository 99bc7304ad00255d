"""Not-modified revisits of a web archive, resolved to the response that they confirm.

A revisit record says that a resource had not changed: its body is that of an earlier capture. An as-of join by
canonical URL finds the latest earlier full response; its validators are checked against the revisit's, and the header
fields that a 304 answer may carry replace the stored ones.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docketlake.llm.common import read

#: Fields of a 304 answer that update a stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

#: Scheme, host, path and query of a URL.
PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(?:[?]([^#]*))?"

#: Rows of a time slice on average, and bounds of their number: one URL's captures are spread over the slices.
SLICE_ROWS, LEAST_SLICES, MOST_SLICES = 500_000, 64, 1024

#: Records of a WARC file handed on together.
RECORDS = 1000

CAPTURES = "record_id long, url string, at long, kind string, status int, etag string, last_modified string, headers map<string,string>"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, path without closing slashes, query fields sorted; no scheme and
    no fragment. Null stays null."""
    part = lambda k: F.regexp_extract(url, PARTS, k)
    host = F.regexp_replace(F.regexp_replace(F.lower(part(1)), "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(part(2), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(F.split(part(3), "&", -1), lambda x: x != "")), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _weak(etag: Column) -> Column:
    """Validators are compared weakly: W/ does not count."""
    return F.regexp_replace(etag, "^W/", "")


def resolve(captures: DataFrame) -> DataFrame:
    """A row for each revisit: record_id, canonical_url, resolved_id, outcome and headers.

    ``captures`` has the columns of CAPTURES; a response is full if its status is 200. The latest full response earlier
    in (at, record_id) decides. ``outcome``: *resolved* (the validators agree: etag if the revisit has one, otherwise
    last_modified), *changed* (they do not), *unverified* (the revisit has none), *missing* (no earlier response, or no
    URL). ``headers`` are the response's with the permitted fields of the revisit, whose names may be in any case, and
    null unless resolved. Repeated rows give repeated results; null headers count as none; an empty table gives no rows.
    """
    n, edges = captures.agg(F.count("*"), F.percentile_approx("at", [k / LEAST_SLICES for k in range(1, LEAST_SLICES)])).first()
    if n > LEAST_SLICES * SLICE_ROWS:
        wanted = min(MOST_SLICES, n // SLICE_ROWS)
        edges = captures.agg(F.percentile_approx("at", [k / wanted for k in range(1, wanted)])).first()[0]
    bounds = F.array(*[F.lit(int(x)) for x in sorted(set(edges or []))]) if edges else F.array().cast("array<long>")
    none = F.create_map().cast("map<string,string>")
    full = (F.col("kind") == "response") & (F.col("status") == 200) & F.col("url").isNotNull()
    payload = F.struct("record_id", "etag", "last_modified", F.coalesce("headers", none).alias("headers"))
    events = captures.select(
        canonical_url(F.col("url")).alias("canonical_url"),
        F.coalesce(canonical_url(F.col("url")), F.concat(F.lit("\x00"), F.col("record_id").cast("string"))).alias("_key"),
        F.size(F.filter(bounds, lambda x: x < F.col("at"))).alias("_slice"),
        "at", "record_id", "kind", "etag", "last_modified", F.coalesce("headers", none).alias("headers"),
        F.when(F.coalesce(full, F.lit(False)), payload).alias("_full"),
    )
    within = Window.partitionBy("_key", "_slice").orderBy("at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    revisits = events.withColumn("_near", F.last("_full", ignorenulls=True).over(within)).where("kind = 'revisit'").drop("_full")
    # what earlier slices hand on: a row for each URL and slice
    last = events.groupBy("_key", "_slice").agg(F.max_by("_full", F.when(F.col("_full").isNotNull(), F.struct("at", "record_id"))).alias("_last"))
    across = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("_key", "_slice", F.last("_last", ignorenulls=True).over(across).alias("_far"))
    found = revisits.join(handed, ["_key", "_slice"], "left").withColumn("_found", F.coalesce("_near", "_far"))
    same = F.when(F.col("etag").isNotNull(), F.coalesce(_weak(F.col("etag")) == _weak(F.col("_found.etag")), F.lit(False))).otherwise(
        F.coalesce(F.col("last_modified") == F.col("_found.last_modified"), F.lit(False))
    )
    outcome = (
        F.when(F.col("_found").isNull(), "missing")
        .when(F.col("etag").isNull() & F.col("last_modified").isNull(), "unverified")
        .when(same, "resolved")
        .otherwise("changed")
    )
    fresh = F.map_filter("headers", lambda k, _: F.lower(k).isin(*PERMITTED))
    names = F.transform(F.map_keys(fresh), F.lower)
    merged = F.map_concat(F.map_filter("_found.headers", lambda k, _: ~F.array_contains(names, F.lower(k))), fresh)
    judged = found.withColumn("outcome", outcome)
    return judged.select(
        "record_id",
        "canonical_url",
        F.when(F.col("outcome").isin("resolved", "unverified"), F.col("_found.record_id")).alias("resolved_id"),
        "outcome",
        F.when(F.col("outcome") == "resolved", merged).alias("headers"),
    )


def _http(block: bytes) -> tuple[int | None, dict[str, str]]:
    head = block.split(b"\r\n\r\n", 1)[0].decode("latin-1").split("\r\n")
    status = head[0].split(" ")[1] if head and head[0].startswith("HTTP/") and len(head[0].split(" ")) > 1 else ""
    fields = (line.partition(":") for line in head[1:])
    return (int(status) if status.isdigit() else None), {k.strip().lower(): v.strip() for k, sep, v in fields if sep}


def _records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Header fields, block and problem of each record of a WARC file, which is unpacked as it is read."""
    raw = io.BytesIO(data)
    stream = gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw
    fields: dict[str, str] = {}
    try:
        while line := stream.readline():
            if not line.startswith(b"WARC/"):
                continue
            fields = {}
            while (line := stream.readline()).rstrip(b"\r\n"):
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            length = fields.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                yield fields, b"", "no content length"  # the next record is looked for from here
                continue
            block = stream.read(int(length))
            yield fields, block, None if len(block) == int(length) else "truncated record"
            fields = {}
    except (EOFError, OSError, zlib.error):
        yield fields, b"", "truncated archive"


def _seconds(date: str | None) -> tuple[int | None, str | None]:
    """WARC-Date, with or without a fraction of a second, in microseconds, or what is wrong with it."""
    if not date:
        return None, "no date"
    try:
        when = pd.Timestamp(date)
        return int((when.tz_localize("UTC") if when.tzinfo is None else when).value // 1000), None
    except (ValueError, OverflowError):
        return None, "no date"


def parsed_warc(spark: SparkSession, path: str) -> DataFrame:
    """The response and revisit records of WARC files in the columns of CAPTURES, with ``file``, ``place`` and ``problem``.

    ``problem`` is null for a sound record, and otherwise tells why it is none: *no content length*, *truncated record*,
    *truncated archive* (of which the records before the break are kept), *no date*. Files are read whole, as Spark's
    binaryFile does (at most 2 GB each, packed), and unpacked record by record.
    """

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                rows = []
                for place, (fields, block, problem) in enumerate(_records(bytes(content))):
                    kind = fields.get("warc-type")
                    other = kind not in ("response", "revisit") or (kind == "revisit" and "not-modified" not in fields.get("warc-profile", ""))
                    if other and not problem:
                        continue
                    status, headers = _http(block)
                    when, undated = _seconds(fields.get("warc-date"))
                    rows.append((name, place, fields.get("warc-target-uri"), when, kind, status, headers.get("etag"), headers.get("last-modified"), headers, problem or undated))
                    if len(rows) == RECORDS:
                        yield framed(rows)
                        rows = []
                yield framed(rows)

    def framed(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["file", "place", "url", "at", "kind", "status", "etag", "last_modified", "headers", "problem"])
        return out.astype({"at": "Int64", "status": "Int32"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInPandas(parse, "file string, place long, " + CAPTURES.removeprefix("record_id long, ") + ", problem string")
    number = F.xxhash64("file").bitwiseAND(F.lit((1 << 42) - 1)) * (1 << 20) + F.col("place")
    return rows.select(number.alias("record_id"), "url", "at", "kind", "status", "etag", "last_modified", "headers", "file", "place", "problem")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The sound response and revisit records of WARC files, plain or gzipped, in the columns of CAPTURES.

    ``at`` is WARC-Date in microseconds; ``record_id`` numbers the records of all files by file path and place. Only 304
    revisits (profile server-not-modified) are kept; other records are passed over, and unsound ones are rows of
    ``parsed_warc`` with a problem.
    """
    return parsed_warc(spark, path).where("problem is null").drop("file", "place", "problem")


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures made of the pages table: each page is answered once (404 for one in eleven) and revisited once.

    The revisit carries, by page_id modulo 4, the right etag, a stale one, the modification date alone, or no validator.
    """
    id_, text = F.col("page_id"), lambda x: F.concat(F.lit(x), F.col("page_id").cast("string"))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 16), F.lit('"'))
    turn = id_ % 4
    stored = F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), text("day "), F.lit("server"), F.lit("archive"))
    fresh = F.create_map(F.lit("content-type"), F.lit("text/plain"), F.lit("date"), text("later "), F.lit("cache-control"), F.lit("max-age=60"))
    response = F.struct(
        (id_ * 2).alias("record_id"), "url", (id_ * 2).alias("at"), F.lit("response").alias("kind"), F.when(id_ % 11 == 10, 404).otherwise(200).alias("status"),
        F.when(id_ % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag).alias("etag"), text("modified ").alias("last_modified"), stored.alias("headers"),
    )
    revisit = F.struct(
        (id_ * 2 + 1).alias("record_id"), "url", (id_ * 2 + 1).alias("at"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.when(turn == 0, tag).when(turn == 1, F.lit('"stale"')).alias("etag"), F.when(turn == 2, text("modified ")).alias("last_modified"), fresh.alias("headers"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("_c")).select("_c.*")


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(captures_of(read(spark, sf_dir, "pages")))
    fields = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda x: F.concat_ws("=", x["key"], x["value"]))), ";")
    return found.select(((F.col("record_id") - 1) / 2).cast("long").alias("page_id"), "canonical_url", (F.col("resolved_id") / 2).cast("long").alias("resolved_page_id"), "outcome", fields.alias("headers"))


ORACLE = rf"""
WITH u AS (
    SELECT page_id, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag,
        regexp_replace(regexp_replace(lower(regexp_extract(url, '{PARTS}', 1)), '^www[0-9]*[.]', ''), ':(80|443)$', '') AS host,
        regexp_replace(regexp_extract(url, '{PARTS}', 2), '/+$', '') AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '{PARTS}', 3), '&'), lambda x: x <> '')), '&') AS query
    FROM pages
), p AS (
    SELECT page_id, tag, host || CASE path WHEN '' THEN '/' ELSE path END || CASE query WHEN '' THEN '' ELSE '?' || query END AS canonical_url FROM u
), f AS (
    SELECT * FROM p WHERE page_id % 11 <> 10
), j AS (
    SELECT p.page_id, p.canonical_url, p.tag, f.page_id AS found, f.tag AS found_tag
    FROM p ASOF LEFT JOIN f ON p.canonical_url = f.canonical_url AND p.page_id >= f.page_id
), o AS (
    SELECT *, CASE WHEN found IS NULL THEN 'missing' WHEN page_id % 4 = 3 THEN 'unverified'
        WHEN (page_id % 4 = 0 AND tag = found_tag) OR (page_id % 4 = 2 AND page_id = found) THEN 'resolved' ELSE 'changed' END AS outcome
    FROM j
)
SELECT page_id, canonical_url, CASE WHEN outcome IN ('resolved', 'unverified') THEN found END AS resolved_page_id, outcome,
    CASE WHEN outcome = 'resolved' THEN 'cache-control=max-age=60;content-type=text/html;date=later ' || page_id || ';server=archive' END AS headers
FROM o
"""
