"""The corpus pipeline, stage by stage and as a whole."""

import re

import corpus_pipeline
import helpers
import numpy as np
import pytest

from tillstream.llm import exact_dedup, packing, queries, substrings
from tillstream.llm.common import read

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The documents, then what each stage but the last leaves."""
    from tillstream.llm.common import stored
    out = [read(spark, sf_dir, "documents")]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out.append(stored(stage(spark, out[-1], sf_dir), "test-stage"))
    return out


def test_columns_stay(stages):
    assert all(s.schema.simpleString() == stages[0].schema.simpleString() for s in stages)


def test_low_quality_goes(spark, sf_dir, stages):
    predicted = {r.doc_id for r in queries.op7_pairwise_quality(spark, sf_dir).collect()
                 if r.predicted}
    assert {r.doc_id for r in stages[1].collect()} == predicted


def test_copies_go(stages):
    before, after = stages[1], stages[2]
    kept = {r.doc_id for r in exact_dedup.deduplicate(before).collect() if r.kept}
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)
    assert all(r.group_size == 1 for r in exact_dedup.deduplicate(after).collect())


def test_near_copies_go(stages):
    """Of what five-word shingles link at a Jaccard similarity of 0.8, the smallest doc_id stays."""
    def shingles(text):
        words = re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER))
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}

    docs = sorted((r.doc_id, shingles(r.text)) for r in stages[2].collect())
    least = {doc_id: doc_id for doc_id, _ in docs}
    for k, (one, its) in enumerate(docs):
        for other, others in docs[:k]:
            if least[one] != least[other] and len(its & others) >= 0.8 * len(its | others):
                low, high = sorted((least[one], least[other]))
                least = {d: low if root == high else root for d, root in least.items()}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(set(least.values()))
    assert len(set(least.values())) < len(docs)


def test_passages_go(stages):
    want = {r.doc_id: r for r in substrings.remove_repeats(stages[3]).collect()}
    texts = {r.doc_id: r for r in stages[4].collect()}
    before = {r.doc_id: r for r in stages[3].collect()}
    assert want.keys() == texts.keys()
    for doc_id, r in want.items():
        text = r.kept if r.n_removed else before[doc_id].text
        assert texts[doc_id].text == text and texts[doc_id].n_chars == len(text)
        assert texts[doc_id].source == before[doc_id].source


def test_whole_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).drop("sequence_id").collect()
    want = packing.pack(stages[4], queries.WORD_BPE).drop("sequence_id").collect()
    def key(r):
        return (r.doc_id, r.start)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(len(r.ids) for r in got) == sum(r.length for r in got)
    assert np.all([r.length & (r.length - 1) == 0 for r in got])


def test_stages_take_awkward_rows(spark, sf_dir):
    docs = helpers.documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() <= len(helpers.AWKWARD) or name == "packing"
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_no_swallowed_imports():
    import __spark_entry__
    assert "pipeline" in __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {q.partition("_")[0] for q in __spark_entry__.queries()}
