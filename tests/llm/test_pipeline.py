"""The pipeline against brute force, stage after stage."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import public_tokenizers

import corpus_pipeline
from docketlake.llm import quality_rules
from docketlake.llm.common import read
from tests.llm.fixtures import empty, frame
from tests.llm.test_python import brute_join

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from tokenizers import Tokenizer

    docs = read(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "jaccard_join", "decontamination", "source_mixing", "token_output"]
    by_name = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    first = by_name["quality_rules"](spark, docs, SF)
    kept = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert {r.doc_id for r in first.collect()} == kept and first.columns == docs.columns

    second = by_name["jaccard_join"](spark, first, SF)
    classes = {c for _, c, _, _ in brute_join([(d, rows[d].text, None) for d in kept])}
    assert sorted(r.doc_id for r in second.collect()) == sorted(classes) and second.columns == docs.columns

    third = by_name["decontamination"](spark, second, SF)
    items = [r.text for r in read(spark, SF, "benchmark").collect()]
    clean = {r.doc_id for r in third.collect()}
    assert clean <= classes and not any(t in rows[d].text for d in clean for t in items)
    assert len(classes - clean) <= sum(any(t in rows[d].text for t in items) for d in classes) + 0.02 * len(classes)

    fourth = by_name["source_mixing"](spark, third, SF)
    taken = collections.Counter(r.doc_id for r in fourth.collect())
    assert set(taken) <= clean and max(taken.values()) <= 2 and fourth.columns == docs.columns

    last = by_name["token_output"](spark, fourth, SF).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sums = {d: zlib.crc32(np.array([*whole.encode(rows[d].text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for d in taken}
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in last) == collections.Counter({(d, sums[d]): n for d, n in taken.items()})


def test_run(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    assert found and [r.start for r in sorted(found, key=lambda r: r.start)] == [0, *np.cumsum([r.n_tokens for r in sorted(found, key=lambda r: r.start)])[:-1]]


def test_stages_take_hard_rows_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (frame(spark), empty(spark)):
            found = stage(spark, docs, SF)
            rows = found.collect()
            assert (found.columns == docs.columns) == (name != "token_output")
            assert len(rows) <= 2 * docs.count() and (rows or docs.count() == 0)


def test_a_table_where_nothing_stays(spark):
    docs = frame(spark, [(1, "short", None), (2, None, None)])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
