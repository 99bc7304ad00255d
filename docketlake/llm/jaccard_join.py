"""N-gram Jaccard join by chosen paths.

A text's set holds its runs of SHINGLE words. Texts with the same set are one class before anything is compared. From
each root (a run) sets go down the paths of some sampled tokens (minima of hash functions over the set): two sets share
a child with probability equal to their similarity. Small buckets are compared by brute force, large ones are split by
further tokens, and a large bucket that tokens cannot split (a group of near copies) is compared in blocks of bounded
size. RUNS repeat this; with FANOUT tokens a node, a pair of similarity 0.8 is missed at the root with probability
0.2 ** (RUNS * FANOUT), 2.56e-6, and by its signature with 1.06e-9, in sum 2.561e-6. A pair counts only in the least bucket that both its sets are in, so each link is counted once
and no pair leaves a task: a task gives, for each set, its number of links and the least set it is connected to there.

Sets are compared by 64-bit hashes of their shingles; their classes by 128 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketlake.llm import textvec
from docketlake.llm.common import WORD, read, small_batches, written

SHINGLE, SIMILARITY = 5, 0.8
#: Hash functions of a signature, and how many of them give tokens for paths.
FUNCTIONS, TOKENS = 48, 24
RUNS, FANOUT, DEPTH = 2, 4, 3
#: A larger bucket is split by further tokens; a bucket is dense if a child keeps this share of it.
SMALL, DENSE = 128, 0.5
#: Buckets that may count as hot.
HOT = 1000
#: Sets of a bucket compared in one task: two blocks of at most about this many.
BLOCK = 1024
#: A signature must agree in this share of its functions, seven standard deviations under SIMILARITY, to be compared;
#: a pair of that similarity fails this far more rarely than it is missed by the paths.
PLAUSIBLE = SIMILARITY - 7 * (SIMILARITY * (1 - SIMILARITY) / FUNCTIONS) ** 0.5

NODE = ("a", "b")
_FACTORS = textvec.mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(7919)) | np.uint64(1)


def shingles(chunk: textvec.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each shingle, rows ascending; a text of fewer words than a shingle has one, its whole."""
    starts, ends, rows = chunk.runs()
    hashes = chunk.hashes(starts, ends)
    at, grams = textvec.windows(hashes, rows, SHINGLE, 17)
    words = np.bincount(rows, minlength=chunk.rows)
    first = np.cumsum(words) - words
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if not len(short):
        return grams, rows[at]
    whole = textvec.joint_hash(hashes, first[short], first[short] + words[short], 19)
    of = np.concatenate([rows[at], short])
    order = np.argsort(of, kind="stable")
    return np.concatenate([grams, whole])[order], of[order]


def _distinct(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each row, rows ascending."""
    _, first = np.unique(textvec.mix(hashes ^ textvec.mix(rows.astype(np.uint64))), return_index=True)
    first.sort()
    return hashes[first], rows[first]


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, place, a, b, n, tokens, signature)``: the set's 128-bit name, its size, its path tokens and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places = batch.column("doc_id"), batch.column("place")
            for chunk in textvec.chunks(batch.column("text")):
                hashes, rows = _distinct(*shingles(chunk))
                n = np.bincount(rows, minlength=chunk.rows)
                held, first = np.unique(rows, return_index=True)
                name = np.zeros((2, chunk.rows), np.uint64)
                least = np.zeros((FUNCTIONS, chunk.rows), np.uint64)
                if len(held):
                    name[0, held] = np.add.reduceat(textvec.mix(hashes), first)
                    name[1, held] = np.add.reduceat(textvec.mix(hashes ^ np.uint64(0x5DEECE66D)), first)
                    for row, factor in zip(least, _FACTORS, strict=True):
                        row[held] = np.minimum.reduceat(hashes * factor, first)
                tokens = np.ascontiguousarray(least[:TOKENS].T).view(np.int64)
                bytes_ = np.ascontiguousarray((textvec.mix(least) & np.uint64(255)).astype(np.uint8).T)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(chunk.lo, chunk.rows),
                        places.slice(chunk.lo, chunk.rows),
                        pa.array(name[0].view(np.int64)),
                        pa.array(name[1].view(np.int64)),
                        pa.array(n.astype(np.int32)),
                        pa.ListArray.from_arrays(np.arange(0, tokens.size + 1, TOKENS, dtype=np.int32), pa.array(tokens.ravel())),
                        pa.array([bytes_[k].tobytes() for k in range(chunk.rows)], pa.binary()),
                    ],
                    ["doc_id", "place", "a", "b", "n", "tokens", "signature"],
                )

    schema = "doc_id long, place long, a long, b long, n int, tokens array<long>, signature binary"
    place = F.col("place") if "place" in docs.columns else F.lit(None).cast("long").alias("place")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), place, "text").mapInArrow(run, schema)


def _children(path: Column, sampled: Callable[[int], Column]) -> Column:
    """The paths below ``path``, one for each sampled token."""
    pair = lambda i: F.xxhash64(path, i.cast("long"), F.get("tokens", i.cast("int")))
    return F.explode(F.array(*[pair(sampled(j)) for j in range(FANOUT)]))


def _sized(members: DataFrame, name: str) -> DataFrame:
    """Members of buckets of two sets or more, with the size.

    At most HOT buckets can hold over a HOT-th of all members; their sizes are broadcast, so that no bucket's members
    have to meet in one task.
    """
    sizes = written(members.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1"), f"{name}-sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    hot = F.broadcast(sizes.where(F.col("size") > total / HOT))
    rest = members.join(hot.select("leaf"), "leaf", "left_anti").join(sizes.where(F.col("size") <= total / HOT), "leaf")
    return written(members.join(hot, "leaf").unionByName(rest), name)


def _kept(rows: DataFrame, dense: DataFrame, inside: bool) -> DataFrame:
    """Rows whose bucket is (not) among the dense ones. The HOT largest of these are broadcast, for the same reason."""
    hot = F.broadcast(dense.orderBy(F.col("size").desc(), "leaf").limit(HOT).select("leaf"))
    rest = dense.select("leaf").join(hot, "leaf", "left_anti")
    others = rows.join(hot, "leaf", "left_anti")
    if not inside:
        return others.join(rest, "leaf", "left_anti")
    return rows.join(hot, "leaf", "left_semi").unionByName(others.join(rest, "leaf", "left_semi"))


def _met(rows: DataFrame, info: DataFrame, on: list[str], weight: str) -> DataFrame:
    """``rows`` beside their one row of ``info``. The HOT keys of most weight are broadcast, so that none fills a task."""
    hot = F.broadcast(info.orderBy(F.col(weight).desc(), *on).limit(HOT))
    others = rows.join(hot.select(*on), on, "left_anti")
    return rows.join(hot, on).unionByName(others.join(info, on)).drop(weight)


def buckets(sets: DataFrame) -> DataFrame:
    """``(leaf, a, b, size)``: the buckets to compare, of two sets or more, with their sizes."""
    roots = sets.select(*NODE, "tokens", F.explode(F.array(*[F.lit(r).cast("long") for r in range(RUNS)])).alias("run"))
    members = roots.select(*NODE, _children(F.col("run"), lambda j: F.col("run") * FANOUT + j).alias("leaf"))
    leaves = None
    for depth in range(1, DEPTH + 1):
        sized = _sized(members, f"paths-{depth}")
        if depth == DEPTH or not sized.where(F.col("size") > SMALL).head(1):
            return sized if leaves is None else leaves.unionByName(sized)
        large = sized.where(F.col("size") > SMALL).join(sets.select(*NODE, "tokens"), [*NODE])
        start = lambda j: F.pmod(F.xxhash64("leaf", F.lit(depth)) + j * 5, F.lit(TOKENS))
        below = written(large.select(*NODE, "leaf", "size", _children(F.col("leaf"), start).alias("child")), f"children-{depth}")
        kept = below.groupBy("leaf", "child").agg(F.count("*").alias("n"), F.first("size").alias("size"))
        share = kept.groupBy("leaf").agg(F.max(F.col("n") / F.col("size")).alias("share"), F.first("size").alias("size"))
        dense = written(share.where(F.col("share") >= DENSE), f"dense-{depth}")
        here = sized.where(F.col("size") <= SMALL).unionByName(_kept(sized.where(F.col("size") > SMALL), dense, True))
        leaves = here if leaves is None else leaves.unionByName(here)
        members = _kept(below, dense, False).select(*NODE, F.col("child").alias("leaf"))
    raise AssertionError("the last depth returns")


def compared(leaves: DataFrame) -> DataFrame:
    """Each bucket as pairs of blocks: ``(leaf, i, j, side, ...)``, where ``side`` is the block a set is of."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(*NODE, F.lit(1)), F.col("_blocks")).cast("int")
    rows = leaves.withColumn("_blocks", blocks).withColumn("side", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return rows.withColumn("i", F.least("side", "_other")).withColumn("j", F.greatest("side", "_other")).drop("_blocks", "_other", "size")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal (leaf, i, j) from sorted batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        keys = np.stack([table[c].to_numpy() for c in ("leaf", "i", "j")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts[:-1]], cuts, strict=False):
            yield table.slice(lo, hi - lo)
        rest = table.slice(cuts[-1] if len(cuts) else 0).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _pairs(group: pa.Table) -> np.ndarray:
    """Plausible pairs of a group that are compared here and in no other bucket, as two rows of indexes, k < l."""
    signature = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, FUNCTIONS)
    n, side = group["n"].to_numpy().astype(float), group["side"].to_numpy()
    i, j, leaf = (group[c][0].as_py() for c in ("i", "j", "leaf"))
    found = []
    for k in range(len(n) - 1):
        rest = slice(k + 1, None)
        agree = (signature[rest] == signature[k]).mean(axis=1) >= PLAUSIBLE
        agree &= np.minimum(n[rest], n[k]) >= SIMILARITY * np.maximum(n[rest], n[k])
        if i != j:
            agree &= side[rest] != side[k]
        if agree.any():
            at = np.flatnonzero(agree) + k + 1
            found.append(np.stack([np.full(len(at), k), at]))
    if not found:
        return np.zeros((2, 0), np.int64)
    pairs = np.concatenate(found, axis=1)
    # buckets before this one in order of their keys, which a pair may share as well
    lists = group["leaves"].combine_chunks()
    keys, of = np.asarray(lists.flatten()), np.repeat(np.arange(len(n)), np.diff(np.asarray(lists.offsets)))
    earlier = keys < leaf
    names, column = np.unique(keys[earlier], return_inverse=True)
    held = np.zeros((len(n), len(names)), np.float32)
    held[of[earlier], column] = 1
    shared = held @ held.T
    return pairs[:, shared[pairs[0], pairs[1]] == 0]


def _verified(pairs: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """The pairs whose Jaccard similarity reaches SIMILARITY."""
    if not pairs.shape[1]:
        return pairs
    size = np.array([len(s) for s in sets])
    if pairs.shape[1] <= 8:
        common = np.array([len(np.intersect1d(sets[k], sets[l], assume_unique=True)) for k, l in pairs.T])
    else:
        values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(column[times[column] > 1], kind="stable")
        row, column = row[times[column] > 1][order], column[times[column] > 1][order]
        column = np.cumsum(np.diff(column, prepend=column[:1]) > 0)
        matrix = np.zeros((len(sets), len(sets)), np.float32)
        step = 8192
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            a, b = np.searchsorted(column, [lo, lo + step])
            held = np.zeros((len(sets), step), np.float32)
            held[row[a:b], column[a:b] - lo] = 1
            matrix += held @ held.T
        common = matrix[pairs[0], pairs[1]].astype(np.int64)
    both = size[pairs[0]] + size[pairs[1]] - common
    return pairs[:, 5 * common >= 4 * both] if SIMILARITY == 0.8 else pairs[:, common >= SIMILARITY * both]


def _sorted_groups(rows: DataFrame) -> DataFrame:
    return rows.repartition("leaf", "i", "j").sortWithinPartitions("leaf", "i", "j")


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, ra, rb, links)``: for a set and a bucket, its links found there and the least set it hangs on to."""
    leaves = written(buckets(sets.where("n > 0")), "leaves")
    own = leaves.groupBy(*NODE).agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    known = sets.select(*NODE, "n", "signature", "rep").join(own, [*NODE])
    rows = compared(leaves).join(known, [*NODE])

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            used = np.unique(_pairs(group))
            if len(used):
                yield from group.take(pa.array(used)).combine_chunks().to_batches()

    schema = "leaf long, i int, j int, side int, a long, b long, n int, signature binary, leaves array<long>, rep long"
    order = [c.split()[0] for c in schema.split(", ")]
    wanted = written(_sorted_groups(rows.select(order)).mapInArrow(needed, schema), "compared")

    def shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in NODE)
            for chunk in textvec.chunks(batch.column("text")):
                hashes, of = _distinct(*shingles(chunk))
                bounds = np.searchsorted(of, np.arange(chunk.rows + 1))
                out: list[tuple] = []
                for k in range(chunk.rows):
                    own = np.sort(hashes[bounds[k] : bounds[k + 1]])
                    if len(own) and np.add.reduce(textvec.mix(own)).view(np.int64) == a[chunk.lo + k]:
                        out.append((int(a[chunk.lo + k]), int(b[chunk.lo + k]), own.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), pa.array([x[1] for x in out]), pa.array([x[2] for x in out], pa.binary())], ["a", "b", "shingles"])

    used = wanted.select(*NODE, "rep").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(used.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("rep")))
    held = texts.select(*NODE, "text").mapInArrow(shingle_sets, "a long, b long, shingles binary").dropDuplicates([*NODE])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            sets = [np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()]
            pairs = _verified(_pairs(group), sets)
            if not pairs.shape[1]:
                continue
            n = group.num_rows
            a, b = (group[c].to_numpy() for c in NODE)
            count = np.bincount(pairs.ravel(), minlength=n)
            order = np.lexsort((b, a))
            rank = np.empty(n, np.int64)
            rank[order] = np.arange(n)
            while True:  # the least rank spreads over the links
                before = rank.copy()
                np.minimum.at(rank, pairs[0], before[pairs[1]])
                np.minimum.at(rank, pairs[1], before[pairs[0]])
                rank = np.minimum(rank, rank[order[rank]])
                if (rank == before).all():
                    break
            at = np.flatnonzero(count)
            root = order[rank[at]]
            yield pa.RecordBatch.from_arrays([pa.array(a[at]), pa.array(b[at]), pa.array(a[root]), pa.array(b[root]), pa.array(count[at])], ["a", "b", "ra", "rb", "links"])

    ready = _sorted_groups(wanted.join(held, [*NODE]).select(*order, "shingles"))
    return ready.mapInArrow(verify, "a long, b long, ra long, rb long, links long")


def components(edges: DataFrame) -> DataFrame:
    """``(a, b, ca, cb)``: the least node of each node's component, from edges (a, b) to (ra, rb).

    Each round, a node takes the least label among its neighbours' and then that label's own; the labels are written to
    the shared folder, and nothing but the number of changes comes to the driver.
    """
    node, root = F.struct("a", "b"), F.struct(F.col("ra").alias("a"), F.col("rb").alias("b"))
    pairs = edges.select(node.alias("u"), root.alias("v")).where("u != v").distinct()
    both = written(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))), "edges")
    # a node with many neighbours, and a label with many nodes, is met by broadcast
    degrees = written(both.groupBy("v").agg(F.count("*").alias("_size")), "degrees")
    labels = written(both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("label")), "labels")
    while True:
        known = labels.select(F.col("u").alias("v"), F.col("label").alias("_near")).join(degrees, "v")
        near = _met(both, known, ["v"], "_size").groupBy("u").agg(F.min("_near").alias("_near"))
        lowered = written(labels.join(near, "u").select("u", F.col("label").alias("_old"), F.least("label", "_near").alias("label")), "lowered")
        sizes = lowered.groupBy("label").agg(F.count("*").alias("_size"))
        jump = written(lowered.select(F.col("u").alias("label"), F.col("label").alias("_next")).join(sizes, "label"), "jump")
        labels = written(_met(lowered, jump, ["label"], "_size").select("u", "_old", F.least("label", "_next").alias("label")), "labels")
        if not labels.where("label != _old").head(1):
            return labels.select("u.a", "u.b", F.col("label.a").alias("ca"), F.col("label.b").alias("cb"))
        labels = labels.drop("_old")


def _classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signature rows (doc_id, place, a, b), and each set's class (ca, cb: the least set of its group, itself if alone),
    class_id, n_links and copies."""
    small_batches(docs.sparkSession)
    table = written(signatures(docs), "signatures")
    sets = written(
        table.groupBy(*NODE).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.first("signature").alias("signature")),
        "sets",
    )
    found = written(links(docs, sets), "links")
    counts = found.groupBy(*NODE).agg(F.sum("links").alias("n_links"))
    classes = written(sets.select(*NODE, "rep", "copies").join(components(found), [*NODE], "left").join(counts, [*NODE], "left"), "classes")
    least = written(classes.where("ca is not null").groupBy("ca", "cb").agg(F.min("rep").alias("class_id"), F.count("*").alias("size")), "least")
    grouped = _met(classes.where("ca is not null"), least, ["ca", "cb"], "size")
    alone = classes.where("ca is null").withColumn("ca", F.col("a")).withColumn("cb", F.col("b")).withColumn("class_id", F.col("rep"))
    named = grouped.unionByName(alone).select(*NODE, "ca", "cb", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "copies")
    return table.select("doc_id", "place", *NODE), written(named, "named")


def join(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (the least doc_id of its group of near copies), n_links and n_copies.

    ``n_links`` counts the different sets of similarity SIMILARITY or more, ``n_copies`` the other rows with the same
    set. Texts without words, null ones included, have the same empty set and form one class. Null doc_ids count last:
    a class has a null class_id only if all its ids are null. Repeated rows are copies of each other; an empty table
    gives no rows. Only doc_id and text are read.
    """
    rows, sets = _classified(docs)
    info = sets.select(*NODE, "class_id", "n_links", (F.col("copies") - 1).alias("n_copies"), "copies")
    return _met(rows, info, [*NODE], "copies").select("doc_id", "class_id", "n_links", "n_copies")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each group of near copies: that of the least doc_id.

    A null doc_id counts last; among rows of the same doc_id the least set and then the least hash of the text decide.
    Rows of the same doc_id whose texts are no near copies of each other are different documents, and all stay; of rows
    with the same doc_id and text any one does.
    """
    place = F.xxhash64(F.coalesce("text", F.lit("")))
    rows, sets = _classified(docs.select("doc_id", "text", place.alias("place")))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "a", "b", "place")
    first = _met(rows, sets.select(*NODE, "ca", "cb", "copies"), [*NODE], "copies").groupBy("ca", "cb").agg(F.min(rank).alias("_first"))
    kept = first.select(F.col("_first.doc_id").alias("_kept"), F.col("_first.place").alias("_kept_place"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"), place.alias("_place"))
    same = F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_place") == F.col("_kept_place"))
    return whole.join(kept.hint("shuffle_hash"), same, "left_semi").dropDuplicates(["_id", "_place"]).select("_row.*")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents"))


ORACLE = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(ws) >= {SHINGLE} THEN list_sort(list_distinct(list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' '))))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ') || ' '] ELSE [] END AS sh FROM d
), c AS (
    SELECT md5(array_to_string(sh, chr(10))) AS fp, min(doc_id) AS rep, count(*) AS copies, any_value(sh) AS sh FROM s GROUP BY 1
), x AS MATERIALIZED (
    SELECT fp, len(sh) AS n, unnest(sh) AS g FROM c
), e AS MATERIALIZED (
    SELECT a.fp AS u, b.fp AS v FROM x a JOIN x b ON a.g = b.g AND a.fp <> b.fp GROUP BY a.fp, b.fp, a.n, b.n HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), r AS (
    SELECT fp AS u, fp AS v FROM c UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u
), k AS (
    SELECT r.u AS fp, min(c.rep) AS class_id FROM r JOIN c ON r.v = c.fp GROUP BY 1
), l AS (
    SELECT u AS fp, count(*) AS n_links FROM e GROUP BY 1
)
SELECT s.doc_id, k.class_id, coalesce(l.n_links, 0) AS n_links, c.copies - 1 AS n_copies
FROM s JOIN c ON md5(array_to_string(s.sh, chr(10))) = c.fp JOIN k ON k.fp = c.fp LEFT JOIN l ON l.fp = c.fp
"""
