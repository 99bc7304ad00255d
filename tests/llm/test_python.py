"""Classifier, language model, Jaccard join, substring dedup, token output, decontamination."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketlake.llm import blocks, decontamination, jaccard_join, lm_scoring, quality_classifier, substring_dedup, textvec, token_output
from docketlake.llm.common import read, scratch
from tests.llm.fixtures import corpus, empty, frame

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- words as arrays


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b日😀", max_size=30)), max_size=8), st.integers(1, 64))
def test_runs_and_windows(texts, limit):
    words, grams, plain = [], collections.defaultdict(set), []
    for chunk in textvec.chunks(pa.array(texts, pa.string()), limit):
        starts, ends, rows = chunk.runs()
        raw = chunk.data.tobytes()
        own = [raw[a:b].decode() for a, b in zip(starts, ends)]
        words += [(chunk.lo + r, w) for r, w in zip(rows, own)]
        at, hashes = textvec.windows(chunk.hashes(starts, ends), rows, 2)
        for k, h in zip(at, hashes):
            grams[int(h)].add((own[k], own[k + 1]))
            plain.append((chunk.lo + rows[k], own[k], own[k + 1]))
    split = [WORD.findall(t or "") for t in texts]
    assert words == [(i, w) for i, ws in enumerate(split) for w in ws]
    assert plain == [(i, a, b) for i, ws in enumerate(split) for a, b in itertools.pairwise(ws)]
    assert all(len(g) == 1 for g in grams.values()) and len(grams) == len({(a, b) for _, a, b in plain})


def test_hashes_do_not_depend_on_how_a_text_is_cut(monkeypatch):
    text = " ".join(random.Random(2).choice(["a", "bc", "def", "x" * 40]) for _ in range(500))
    chunk = next(textvec.chunks(pa.array([text])))
    starts, ends, _ = chunk.runs()
    whole = chunk.hashes(starts, ends)
    for limit in (1, 7, 64):
        monkeypatch.setattr(textvec, "CHUNK_BYTES", limit)
        assert (chunk.hashes(starts, ends) == whole).all()


def test_a_very_long_text_and_many_long_ones(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(5000)]
    passage = [rnd.choice(words) for _ in range(30)]
    long = lambda n: [rnd.choice(words) for _ in range(n)]
    texts = [long(1_000_000), *([*long(70_000), *passage] for _ in range(12))]
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(1)
    found = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.deduplicated(df, texts=False).collect()}
    assert found == {0: (1_000_000, 0), 1: (70_030, 0), **{k: (70_030, 30) for k in range(2, 13)}}
    assert jaccard_join.join(df).where("n_links > 0").count() == 0 and quality_classifier.document_statistics(df).count() == 13


# --- classifier


def test_classifier_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    found = quality_classifier.op1_quality_classifier(spark, SF).collect()
    assert len(found) == read(spark, SF, "documents").count()
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    out = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert np.mean([(s >= 0.5) == y for s, y in out]) >= 0.95


def test_classifier_hard_rows(spark):
    labels = spark.createDataFrame([(i, int(i < 400), None) for i in [*range(30), 406, 410, 411, 412]] + [(1, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality_classifier.classify(frame(spark), labels).collect()
    assert len(found) == len(corpus()) and sum(r.doc_id is None for r in found) == 2 and all(not math.isnan(r.score) for r in found)
    assert quality_classifier.classify(empty(spark), labels).count() == 0
    assert {r.score for r in quality_classifier.classify(frame(spark), labels.limit(0)).collect()} == {0.5}


@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_isotonic(points):
    v, w = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
    fit = quality_classifier.isotonic(v, w)
    brute = [max(min(np.average(v[a : b + 1], weights=w[a : b + 1]) for b in range(i, len(v))) for a in range(i + 1)) for i in range(len(v))]
    assert np.allclose(fit, brute)


# --- language model


def brute_lattice(word: bytes, weight: dict[bytes, float]) -> float:
    text = lm_scoring.MARK + word
    alpha = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        alpha[j] = sum(alpha[i] * weight.get(text[i:j], 0.0) for i in range(max(0, j - lm_scoring.LONGEST), j))
    return alpha[-1]


def test_lattice_adds_all_splits():
    pieces = lm_scoring.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    weight = dict(zip(pieces.pieces, np.exp(pieces.log_weight)))
    assert sum(weight.values()) + math.exp(pieces.log_end) == pytest.approx(1)
    words = [b"the", b"a", "é日".encode(), b"thention", b"x" * 40, bytes(range(33, 60))]
    assert np.allclose(lm_scoring.log_probabilities(pa.array(words, pa.binary()), pieces), [math.log(brute_lattice(w, weight)) for w in words])


def test_long_pieces_count():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, pieces = sentencepiece.SentencePieceProcessor(model_file=path), lm_scoring.Pieces.load(path)
    plain = [model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    long = {p for p in plain if len(p) > 16 and b" " not in p[1:]}
    assert len(long) == 20 and long <= set(pieces.pieces)
    weight = dict(zip(pieces.pieces, np.exp(pieces.log_weight)))
    words = [p[1:] if p.startswith(b" ") else b"x" + p for p in sorted(long)]
    brute = []
    for w in words:
        alpha = [1.0]
        for j in range(1, len(w) + 2):
            alpha.append(sum(alpha[i] * weight.get((b" " + w)[i:j], 0.0) for i in range(j)))
        brute.append(math.log(alpha[-1]))
    assert np.allclose(lm_scoring.log_probabilities(pa.array(words, pa.binary()), pieces), brute)


def test_expected_counts_explain_every_byte():
    pieces = lm_scoring.Pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    cells = np.frombuffer(b" thention there  ", np.uint8)[:16].reshape(2, 8)
    used = lm_scoring.Lattice(cells, pieces).expected(np.array([2.0, 3.0]), len(pieces.pieces))
    assert sum(n * len(p) for n, p in zip(used, pieces.pieces)) == pytest.approx(5 * 8)


def lm_rows(rows):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [(d, WORD.findall(lower(t))) for d, t, _ in rows]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    counts = collections.Counter()
    for d, ws in tokens:
        if not out(d):
            counts.update(ws)
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    for d, ws in tokens:
        own = [*ws, None]
        yield d, out(d), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)


def test_language_model(spark):
    found = lm_scoring.scored(frame(spark), public_tokenizers.path("piece_bpe_32k.model"), rounds=1).collect()
    ours = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert ours == collections.Counter(lm_rows(corpus()))
    assert all(r.score < 0 for r in found) and len({r.score for r in found if r.n_tokens == 1}) == 1
    assert lm_scoring.scored(empty(spark), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_fitting_raises_likelihood(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    held = lambda rounds: lm_scoring.scored(read(spark, SF, "documents"), path, rounds).where("held_out").agg(F.sum("score")).first()[0]
    assert held(2) > held(0)


# --- Jaccard join


def brute_join(rows):
    shingles = lambda ws: frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset([tuple(ws)] if ws else [])
    sets = [shingles(WORD.findall(t or "")) for _, t, _ in rows]
    distinct = list(dict.fromkeys(sets))
    root = list(range(len(distinct)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    degree = collections.Counter()
    for (i, a), (j, b) in itertools.combinations(enumerate(distinct), 2):
        if a and b and 5 * len(a & b) >= 4 * len(a | b):
            degree[a] += 1
            degree[b] += 1
            root[find(j)] = find(i)
    at = {s: find(i) for i, s in enumerate(distinct)}
    least: dict = {}
    for (d, _, _), s in zip(rows, sets):
        if d is not None:
            least[at[s]] = min(d, least.get(at[s], d))
    copies = collections.Counter(sets)
    return collections.Counter((d, least.get(at[s]), degree[s], copies[s] - 1) for (d, _, _), s in zip(rows, sets))


def test_jaccard_join(spark):
    found = collections.Counter(tuple(r) for r in jaccard_join.join(frame(spark)).collect())
    assert found == brute_join(corpus())
    assert jaccard_join.join(empty(spark)).count() == 0 and jaccard_join.one_of_each(empty(spark)).count() == 0


def test_large_groups_are_split_and_compared_in_blocks(spark, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    base = [rnd.choice(words) for _ in range(120)]
    rows = []
    for i in range(60):  # one group of near copies
        text = list(base)
        text[rnd.randrange(120)] = f"new{i}"
        rows.append((i, " ".join(text), None))
    common = " ".join(rnd.choice(words) for _ in range(30))
    rows += [(1000 + i, common + " " + " ".join(rnd.choice(words) for _ in range(60)), None) for i in range(40)]  # a common passage
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    found = collections.Counter(tuple(r) for r in jaccard_join.join(frame(spark, rows)).collect())
    assert found == brute_join(rows)


def test_links_whose_signatures_differ_much(spark):
    need = math.ceil(jaccard_join.PLAUSIBLE * jaccard_join.FUNCTIONS)
    missed = sum(math.comb(jaccard_join.FUNCTIONS, k) * 0.8**k * 0.2 ** (jaccard_join.FUNCTIONS - k) for k in range(need))
    assert missed < 0.01 * 0.2 ** (jaccard_join.RUNS * jaccard_join.FANOUT)
    rows = []
    for i in (473, 8174, 35125):  # similarity 0.8, but 26, 27 and 26 of 48 functions agree
        text = [f"w{i}x{k}" for k in range(49)]
        rows += [(2 * i, " ".join(text), None), (2 * i + 1, " ".join([*text[:24], "changed", *text[25:]]), None)]
    assert collections.Counter(tuple(r) for r in jaccard_join.join(frame(spark, rows)).collect()) == brute_join(rows)


def brute_kept(rows):
    """Of each class, by place: the row of the least doc_id (null last). Rows that share an id are told apart by text."""
    numbered = [(k, t, None) for k, (_, t, _) in enumerate(rows)]
    best = {}
    for k, (_, c, _, _) in zip(range(len(rows)), sorted_join(numbered)):
        rank = (rows[k][0] is None, rows[k][0] or 0)
        best[c] = min(best.get(c, (rank, k)), (rank, k), key=lambda x: x[0])
    return collections.Counter((rows[k][0], rows[k][1]) for _, k in best.values())


def sorted_join(rows):
    return sorted((x for x, n in brute_join(rows).items() for _ in range(n)), key=lambda x: x[0])


def test_one_of_each(spark):
    kept = collections.Counter((r.doc_id, r.text) for r in jaccard_join.one_of_each(frame(spark)).collect())
    assert kept == brute_kept(corpus()) and [d for d, _ in kept].count(6) == 3 and sum(d is None for d, _ in kept) == 2


def test_different_texts_of_one_id_all_stay(spark):
    rows = [(1, "a b c d e f g h", None), (1, "i j k l m n o p", None), (2, "q r s t u v w x", None), (None, "i j k l m n o p", None), (None, "only here and nowhere else", None)]
    found = collections.Counter((r.doc_id, r.text) for r in jaccard_join.one_of_each(frame(spark, rows)).collect())
    assert found == collections.Counter([(1, rows[0][1]), (1, rows[1][1]), (2, rows[2][1]), (None, rows[4][1])])


@pytest.mark.parametrize("hot", [1, 1000])
def test_hot_sets_and_labels_are_met_by_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    found = collections.Counter(tuple(r) for r in jaccard_join.join(frame(spark)).collect())
    assert found == brute_join(corpus())


# --- substring dedup


def brute_dedup(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    seen: set = set()
    for k in order:
        ws = WORD.findall(rows[k][1] or "")
        gone = [False] * len(ws)
        for a in range(len(ws) - 19):
            w = tuple(ws[a : a + 20])
            if w in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(w)
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        yield rows[k][0], len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept


def test_substring_dedup(spark):
    rows = corpus()
    found = collections.Counter(tuple(r) for r in substring_dedup.deduplicated(frame(spark)).collect())
    assert found == collections.Counter(brute_dedup(rows)) and sum(n * r[2] for r, n in found.items()) > 0
    assert substring_dedup.deduplicated(empty(spark)).count() == 0


def test_sketch_never_reports_too_little():
    rnd = np.random.default_rng(1)
    blocks = [(rnd.choice(1 << 40, 400, replace=False).astype(np.uint64), rnd.integers(1, 4, 400)) for _ in range(5)]
    truth = collections.Counter()
    for h, c in blocks:
        truth.update(dict(zip(h.tolist(), c.tolist())))
    for (h, _), e in zip(blocks, substring_dedup.estimates(blocks)):
        assert all(e[k] >= truth[x] for k, x in enumerate(h.tolist())) and np.mean(e == [truth[x] for x in h.tolist()]) > 0.7


# --- token output


@given(st.integers(1, 31), st.integers(0, 300), st.integers(0, 2**32))
@settings(max_examples=60, deadline=None)
def test_packing(bits, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, n)
    packed = token_output.pack(ids, bits)
    assert len(packed) == -(-n * bits // 8) and (token_output.unpack(packed, n, bits) == ids).all()


def test_token_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [*corpus(), (500, "x<|endoftext|>y é́ world's don't\x0b 12,5", None)]
    manifest = token_output.write_shards(frame(spark, rows), scratch(spark, "tokens"), path)
    encoded = sorted(((d, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for d, t, _ in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    found = sorted(token_output.read_shards(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [d for d, _ in encoded]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == collections.Counter((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in encoded)
    assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]]
    one = manifest.orderBy(F.desc("n_ids")).first()
    shard = token_output.Shard.open(one.path)
    assert shard.bits == 16 and len(shard.ids(0, shard.n_ids)) == one.n_ids
    k = len(shard.doc_ids) - 1
    assert shard.document(k).tolist() in [ids for d, ids in encoded if d == shard.doc_ids[k] or shard.nulls[k]]
    assert token_output.read_shards(token_output.write_shards(empty(spark), scratch(spark, "tokens"), path)).count() == 0


# --- decontamination


def test_contamination(spark):
    rnd = random.Random(11)
    words = ["tok" + str(i) for i in range(300)]
    items = [(k, " ".join(rnd.choice(words) for _ in range(40)).capitalize() + ".") for k in range(5)] + [(5, None), (6, "two words"), (None, "")]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    edited = items[1][1].split()
    for at in (5, 15, 28):
        edited[at] = "changed"
    del edited[33]
    rows = [(i, " ".join(prose(150)), None) for i in range(40)]
    rows += [(100, " ".join([*prose(50), items[0][1], *prose(50)]), None), (101, " ".join([*prose(80), *edited, *prose(9)]), None), (102, items[2][1].upper().replace(" ", " - "), None), (103, None, None), (104, "", None)]
    rows += [(200 + i, " ".join([*prose(30), items[3][1]]), None) for i in range(60)]  # an item that many documents hold
    bench = spark.createDataFrame([(*x, 0) for x in items], "item_id long, text string, score int")
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(frame(spark, rows), bench).collect()}
    assert set(found) == {(100, 0), (101, 1), (102, 2), *((200 + i, 3) for i in range(60))}
    assert found[100, 0] == found[102, 2] == 1 and 0.7 < found[101, 1] < 1
    clean = decontamination.clean(frame(spark, rows), bench)
    assert {r.doc_id for r in clean.collect()} == {*range(40), 103, 104} and clean.columns == frame(spark, rows).columns
    assert decontamination.contaminated(empty(spark), bench).count() == 0
    assert decontamination.contaminated(frame(spark, rows), bench.limit(0)).count() == 0 and decontamination.clean(frame(spark, rows), bench.limit(0)).count() == len(rows)


def test_benchmark_in_blocks(spark, monkeypatch):
    whole = sorted(map(tuple, decontamination.op7_decontamination(spark, SF).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 9)
    assert sorted(map(tuple, decontamination.op7_decontamination(spark, SF).collect())) == whole
    items = {r.item_id: r.text for r in read(spark, SF, "benchmark").collect()}
    exact = {(r.doc_id, k) for r in read(spark, SF, "documents").collect() for k, t in items.items() if t in r.text}
    assert exact <= {(d, i) for d, i, _, _ in whole}


def brute_align(item, text):
    best, above = 0, [0] * (len(text) + 1)
    for w in item:
        row = [0]
        for j, v in enumerate(text, 1):
            row.append(max(0, above[j - 1] + (2 if w == v else -1), above[j] - 1, row[j - 1] - 1))
        best, above = max(best, *row), row
    return best


def test_copies_in_many_documents(spark):
    rnd = random.Random(5)
    words = ["tok" + str(i) for i in range(300)]
    items = [[rnd.choice(words) for _ in range(40)] for _ in range(3)]
    edited = lambda item: [f"changed{i}" if i in (5, 15, 25, 33) else w for i, w in enumerate(item)]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    texts = [prose(60) for _ in range(20)]
    texts += [prose(10) + edited(items[0]) + prose(9) for _ in range(5)] + [prose(10) + edited(items[1]) + prose(9) for _ in range(1000)]
    texts += [prose(10) + items[2][:24] + prose(20) for _ in range(60)] + [items[2][:9] + prose(40) for _ in range(60)]  # a part that counts, and one too short
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    rows = [(d, " ".join(x), None) for d, x in enumerate(texts)]
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(frame(spark, rows), bench).collect()}
    brute = {(d, k): brute_align(item, x) / 80 for d, x in enumerate(texts) for k, item in enumerate(items) if len(set(x) & set(item)) >= 20}
    assert found == {x: score for x, score in brute.items() if score >= 0.5} and len(found) == 1065


@given(st.lists(st.integers(1, 4), min_size=1, max_size=8), st.lists(st.lists(st.integers(1, 4), min_size=6, max_size=6), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_alignment(item, texts):
    found = decontamination.align(np.array(item, np.uint64), np.array(texts, np.uint64))
    assert found.tolist() == [brute_align(item, t) for t in texts]


# --- against brute force, as a whole


def brute_statistics(text: str | None) -> list[float]:
    text = text or ""
    raw = text.encode()
    words = [w.encode() for w in WORD.findall(text)]
    share = lambda part, whole: part / max(whole, 1)
    mean = share(sum(map(len, words)), len(words))
    spread = math.sqrt(max(share(sum(len(w) ** 2 for w in words), len(words)) - mean * mean, 0))
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    lines = [x for x in raw.split(b"\n") if x]
    count = lambda chars: sum(b in chars for b in raw)
    upper, lower = bytes(range(65, 91)), bytes(range(97, 123))
    return [
        math.log1p(len(words)), mean, spread, share(count(upper), count(upper + lower)), share(count(b"0123456789"), len(raw)), share(count(b"#*$%&|<>"), len(words)),
        share(count(b"!"), len(words)), share(count(b"|"), len(words)), share(count(b".,;:?!'\"()-"), len(words)), share(count(b"\n"), len(words)),
        share(count(bytes(range(192, 256))), len(raw)), share(len(set(words)), len(words)), share(sum(n for n in grams.values() if n > 1), len(words)),
        share(len(lines) - len(set(lines)), len(lines)), math.log1p(share(len(raw), len(lines))), share(count(b" \t\n\x0b\x0c\r"), len(raw)),
    ]


def test_classifier_against_brute_force(spark):
    rows = [r for r in corpus() if r[0] is not None and r[0] not in (5, 6)]
    table = quality_classifier.document_statistics(frame(spark, rows))
    x = {r.doc_id: r.x for r in table.collect()}
    assert all(np.allclose(x[d], brute_statistics(t)) for d, t, _ in rows)
    labelled = table.select("x", (F.col("doc_id") < 400).cast("double").alias("y"))
    model = quality_classifier.fit(labelled)
    xs, y = np.array([x[d] for d, _, _ in rows]), np.array([float(d < 400) for d, _, _ in rows])
    random = np.random.default_rng(quality_classifier.SEED)
    k, wide = len(quality_classifier.STATISTICS), quality_classifier.FEATURES
    frequencies, phases = random.normal(0, 1 / quality_classifier.WIDTH, (k, wide)), random.uniform(0, 2 * np.pi, wide)
    scale = np.where(xs.std(axis=0) > 1e-9, xs.std(axis=0), 1.0)
    z = np.clip((xs - xs.mean(axis=0)) / scale, -quality_classifier.FARTHEST, quality_classifier.FARTHEST)
    features = np.array([[*(math.cos(sum(a * b for a, b in zip(row, frequencies[:, j])) + phases[j]) for j in range(wide)), 1.0] for row in z])
    penalty = math.sqrt(quality_classifier.RIDGE * len(rows))
    ridge = np.linalg.lstsq(np.vstack([features, penalty * np.eye(wide + 1)]), np.concatenate([y, np.zeros(wide + 1)]), rcond=None)[0]
    assert np.allclose(model.raw(xs), features @ ridge, atol=1e-6)
    # each partition adds its part: any number of partitions gives the same model
    again = quality_classifier.fit(labelled.repartition(40))
    assert np.allclose(again.raw(xs), model.raw(xs), atol=1e-6)


def test_sums_are_added_in_a_tree(spark, monkeypatch):
    parts = spark.range(0, 200, 1, 100).select(F.expr("encode(cast(id as string), 'utf-8')").alias("v"))
    made = parts.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"v": [np.array([float(x)]).tobytes() for x in b.column("v").to_pylist()]}) for b in bs), "v binary")
    assert quality_classifier._added(made, 1, 100).tolist() == [sum(range(200))]
    assert quality_classifier._added(made.limit(0), 1, 1).tolist() == [0]


def test_fitted_scores_against_brute_force(spark):
    rows = [r for r in corpus() if r[0] is None or r[0] < 12 or 400 <= r[0] < 406 or r[0] == 408]
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces = lm_scoring.Pieces.load(path)
    weight, end = dict(zip(pieces.pieces, pieces.log_weight)), pieces.log_end
    longest = max(map(len, weight))
    low = lambda t: [b" " + re.sub(rb"[A-Z]", lambda m: m[0].lower(), w.encode()) for w in WORD.findall(t or "")]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    times = collections.Counter(w for d, t, _ in rows if not held(d) for w in low(t))
    ends = sum(not held(d) for d, _, _ in rows)

    def chances(w, forward=True):
        at = [1.0] + [0.0] * len(w)
        for j in range(1, len(w) + 1):
            for i in range(max(0, j - longest), j):
                piece = w[i:j] if forward else w[len(w) - j : len(w) - i]
                at[j] += at[i] * math.exp(weight[piece]) if piece in weight else 0.0
        return at

    for _ in range(lm_scoring.ROUNDS):
        used = collections.Counter()
        for w, n in times.items():
            ahead, back = chances(w), chances(w, False)[::-1]
            for i in range(len(w)):
                for j in range(i + 1, min(len(w), i + longest) + 1):
                    if w[i:j] in weight:
                        used[w[i:j]] += n * ahead[i] * math.exp(weight[w[i:j]]) * back[j] / ahead[-1]
        total = sum(used.values()) + lm_scoring.SMOOTH * len(weight) + ends + 1
        weight, end = {p: math.log((used[p] + lm_scoring.SMOOTH) / total) for p in weight}, math.log((ends + 1) / total)
    expected = sorted((d is not None, d or 0, round((sum(math.log(chances(w)[-1]) for w in low(t)) + end) / math.log(10), 6)) for d, t, _ in rows)
    found = sorted((r.doc_id is not None, r.doc_id or 0, round(r.score, 6)) for r in lm_scoring.scored(frame(spark, rows), path).collect())
    assert [x[:2] for x in found] == [x[:2] for x in expected] and np.allclose([x[2] for x in found], [x[2] for x in expected], atol=1e-4)


def test_contamination_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    split = lambda t: re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = {r.doc_id: split(r.text) for r in read(spark, sf, "documents").collect()}
    items = {r.item_id: split(r.text) for r in read(spark, sf, "benchmark").collect()}
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.op7_decontamination(spark, sf).collect()}
    brute = {}
    for d, text in docs.items():
        held = collections.Counter(text)
        for i, item in items.items():
            if len(item) >= 3 and sum((held & collections.Counter(item)).values()) >= 0.5 * len(item):  # no alignment scores more
                brute[d, i] = brute_align(item, text) / (2 * len(item))
    assert found == pytest.approx({k: v for k, v in brute.items() if v >= decontamination.THRESHOLD}) and found


# --- blocks and sketches


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    listed = blocks.block_files(frame(spark).select("doc_id", "text", "source"))
    rows = listed.collect()
    assert sum(r.n_rows for r in rows) == len(corpus()) and len({r.block for r in rows}) == len(rows)
    tables = [blocks.load(r.path) for r in rows]
    held = collections.Counter((d, t, s) for x in tables for d, t, s in zip(x["doc_id"].to_pylist(), x["text"].to_pylist(), x["source"].to_pylist()))
    assert held == collections.Counter((d, t or "", s) for d, t, s in corpus()) and len({p for x in tables for p in x["place"].to_pylist()}) == len(corpus())


@pytest.mark.parametrize("limit", [500, 5000])
def test_dedup_and_scores_over_many_blocks(spark, monkeypatch, limit):
    path = public_tokenizers.path("piece_bpe_32k.model")
    score = lambda: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in lm_scoring.scored(frame(spark), path, 1).collect())
    one = score()
    monkeypatch.setattr(blocks, "BLOCK_BYTES", limit)
    monkeypatch.setattr("docketlake.llm.common.small_batches", None)
    monkeypatch.setattr(blocks, "small_batches", lambda s: s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5"))
    assert collections.Counter(tuple(r) for r in substring_dedup.deduplicated(frame(spark)).collect()) == collections.Counter(brute_dedup(corpus()))
    assert score() == one


def test_only_counters_leave_a_block_before_the_filter(spark, monkeypatch):
    listed = blocks.block_files(frame(spark).select("doc_id", "text"))
    parts = substring_dedup.sketches(listed, 4, listed.count())
    assert parts.columns == ["slice", "block", "at", "value"]
    rows = parts.collect()
    assert rows and all(0 <= k < substring_dedup.DEPTH * substring_dedup.WIDTH for r in rows for k in r.at)
    # merged by addition: the sum of the blocks' sketches is the sketch of all
    least, once = zip(*[(lambda w: (w.minimisers()[0], np.unique(w.minimisers()[1], return_index=True)[1]))(substring_dedup.BlockWords(blocks.load(r.path))) for r in listed.collect()])
    hashes, counts = np.unique(np.concatenate([a[b] for a, b in zip(least, once)]), return_counts=True)
    for s in range(4):
        own = hashes % np.uint64(4) == s
        whole = substring_dedup.merged([substring_dedup.Sketch.of(hashes[own], counts[own])])
        assert (whole == substring_dedup.merged(substring_dedup.Sketch(np.array(r.at, np.int64), np.array(r.value)) for r in rows if r.slice == s)).all()


def test_wide_ids_are_an_error(spark):
    with pytest.raises(ValueError, match="more than 4 bits"):
        token_output.pack(np.array([3, 16]), 4)
    with pytest.raises(Exception, match="more than 16 bits"):
        token_output.write_shards(frame(spark), scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"), end_id=1 << 20)


def test_cached_words_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_output, "CACHED_BYTES", 4000)
    words = token_output.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    whole = words.tokenizer
    for k in range(60):
        text = " ".join(["often", f"rare{k}", f"x{k}y"])
        assert words.encode(text.encode()).tolist() == [i for w in text.split() for i in whole.encode(w, add_special_tokens=False).ids]
        assert len(words.known) < 30 and b"often" in words.known


def test_words_learnt_together_are_those_of_the_whole_text(monkeypatch):
    monkeypatch.setattr(token_output, "JOINED_WORDS", 7)
    words = token_output.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    letters = [*"ab9.-_'\"", "\u00e9", "e\u0301", "\u0301", "\u00a0", "\u200b", "\u0130", "\ufb01", "\u4e2d", "\U0001f600", "\x00", "\x85", "\u3000", "<|endoftext|>", "[UNK]", " ", "\n", "\t"]
    rng = np.random.default_rng(5)
    for _ in range(2000):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        assert words.encode(text.encode()).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
