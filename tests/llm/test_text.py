"""Packing, BPE, chat formatting and quality ranking."""

import hashlib
import zlib

import helpers
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillstream.llm import bpe, chat, packing, quality, queries
from tillstream.llm.common import read
from tillstream.llm.words import encode, word_ids

_TEXT = st.text(st.sampled_from(
    "aAbzÉéèß×÷ÿΣσǅİſKﬁ 's't're<>=≠!?.,–0123½²٣ \n\t\r\x1c\x85\xa0　漢字🙂"), max_size=24)
_SPECIAL = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", " a<|endoftext|> b"]


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(queries.WORD_BPE)


@pytest.fixture(scope="module")
def byte_tokenizer():
    return Tokenizer.from_file(queries.BYTE_BPE)


@settings(max_examples=1500, deadline=None)
@given(_TEXT, st.sampled_from(["", *_SPECIAL]), _TEXT)
def test_word_ids_equal_the_library(word_tokenizer, before, special, after):
    text = before + special + after
    got = np.frombuffer(encode(word_ids(queries.WORD_BPE), text.encode()), "<u4").tolist()
    assert got == word_tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(_TEXT, st.sampled_from(["", *_SPECIAL]), _TEXT)
def test_trie_ids_equal_the_library(byte_tokenizer, before, special, after):
    text = before + special + after
    [ids] = bpe.trie(queries.BYTE_BPE).encode([text])
    assert ids.tolist() == byte_tokenizer.encode(text, add_special_tokens=False).ids
    assert bpe.decode_ids(bpe.token_bytes(queries.BYTE_BPE), ids).decode() == byte_tokenizer.decode(
        ids.tolist(), skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(byte_tokenizer):
    random = np.random.default_rng(2)
    for _ in range(300):
        ids = random.integers(0, 50257, 6)
        assert bpe.decode_ids(bpe.token_bytes(queries.BYTE_BPE), ids).decode() == byte_tokenizer.decode(
            ids.tolist(), skip_special_tokens=False)


def test_full_tables_start_anew(byte_tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_RUNS", 3)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 5)
    coder = bpe.Trie(queries.BYTE_BPE)
    for text in ("some words here", "other<|endoftext|> words there", "some words again"):
        assert coder.encode([text])[0].tolist() == byte_tokenizer.encode(
            text, add_special_tokens=False).ids


def _coded(byte_tokenizer, text):
    ids = byte_tokenizer.encode(text or "", add_special_tokens=False).ids
    back = byte_tokenizer.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_bpe_whole_table(spark, sf_dir, byte_tokenizer):
    want = {r.doc_id: _coded(byte_tokenizer, r.text)
            for r in read(spark, sf_dir, "documents").collect()}
    got = queries.op10_trie_bpe(spark, sf_dir).collect()
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_bpe_awkward_rows(spark, byte_tokenizer):
    coded = bpe.decode(bpe.encode(helpers.documents(spark), queries.BYTE_BPE), queries.BYTE_BPE)
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in coded.collect()), key=str)
    want = sorted(((i, byte_tokenizer.encode(t or "", add_special_tokens=False).ids, t or "")
                   for i, t in helpers.AWKWARD), key=str)
    assert got == want
    at_once = bpe.encode_and_decode(helpers.documents(spark), queries.BYTE_BPE).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in at_once), key=str) == want
    none = bpe.encode(helpers.documents(spark, []), queries.BYTE_BPE)
    assert bpe.decode(none, queries.BYTE_BPE).collect() == []


def test_binary_lengths():
    assert packing.binary_lengths(1, 8) == [1]
    assert packing.binary_lengths(23, 8) == [8, 8, 4, 2, 1]
    assert all(sum(packing.binary_lengths(n, 4096)) == n for n in range(1, 9000, 7))


def _check_pieces(pieces, want, max_tokens):
    """want: list of (doc_id, ids)."""
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.offset == 0 and p.length & (p.length - 1) == 0 and p.length <= max_tokens
               for p in pieces)
    found = {}
    for p in pieces:
        found.setdefault((p.doc_id, p.start), []).append(p)
    for doc_id, ids in want:
        start = 0
        while start < len(ids):
            p = found[doc_id, start].pop()
            part = np.array(ids[start:start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            if p.ids is not None:
                assert p.ids == ids[start:start + p.length]
            start += p.length
    assert not any(found.values())


def test_packing_awkward_rows(spark, word_tokenizer):
    rows = [(i, t) for i, t in helpers.AWKWARD if i is not None]
    got = packing.pack(helpers.documents(spark, rows), queries.WORD_BPE, 64).collect()
    want = [(i, [*word_tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
            for i, t in rows]
    _check_pieces(got, want, 64)
    everything = packing.pack(helpers.documents(spark), queries.WORD_BPE).collect()
    assert {p.doc_id for p in everything} == {i for i, _ in helpers.AWKWARD}
    assert packing.pack(helpers.documents(spark, []), queries.WORD_BPE).collect() == []
    with pytest.raises(ValueError):
        packing.pack(helpers.documents(spark), queries.WORD_BPE, 100)


def test_packing_whole_table(spark, sf_dir, word_tokenizer):
    want = [(r.doc_id, [*word_tokenizer.encode(r.text, add_special_tokens=False).ids, 2])
            for r in read(spark, sf_dir, "documents").collect()]
    docs = read(spark, sf_dir, "documents")
    _check_pieces(packing.pack(docs, queries.WORD_BPE).collect(), want, 4096)
    assert queries.op5_pack_binary_lengths(spark, sf_dir).count() == packing.pack(
        docs, queries.WORD_BPE).count()


_TURNS = [
    (1, 2, "assistant", "hi </s>"), (1, 1, "user", "hello"), (1, 3, "assistant", "more [MORE] [END]"),
    (2, 0, "system", None), (2, 1, None, "no role"), (2, 2, "assistant", ""),
    (3, 5, "user", r"<\/s> <\\/s> [\INST] [[END] <"), (3, 5, "user", r"<\/s>"), (3, 5, "user", r"<\/s>"),
    (4, None, "assistant", "[SAYS]a\nb"), (4, 1, "ro[SAYS]le\n", "x<s>"), (5, 1, "assistant", "["),
    (None, 1, "user", "nobody's"), (6, 1, "assistant", "🙂 [/INST]"), (6, 2, "user", "|im_end|>"),
    (6, 3, "assistant", "<|im_end|>" * 50),
]


def _conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chat_round_trip(spark):
    out = chat.format_conversations(_conversations(spark, _TURNS).withColumn("formatted", F.lit(1)))
    spans = chat.loss_spans(F.col("formatted"))
    got = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("formatted"), spans).alias("loss"), spans.alias("spans"))
    want = {}
    for conv, turn, role, text in sorted(
            _TURNS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss == "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert len(r.spans) == sum(role == "assistant" for role, _ in want[r.conv_id])
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(want[r.conv_id], want[r.conv_id][1:],
                                                      strict=False))
        assert r.formatted.count("[ROLE]") == blocks


def test_chat_has_no_python(spark, plan_of, sf_dir):
    plan = plan_of(queries.op8_chat_formatting(spark, sf_dir))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_chat_no_rows(spark):
    assert chat.format_conversations(_conversations(spark, [])).collect() == []


def test_chat_query(spark, sf_dir):
    rows = [(r.conv_id, r.turn, r.role, r.text)
            for r in read(spark, sf_dir, "conversations").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv, _, role, text in sorted(rows):
        want.setdefault(conv, []).append((role, text))
    got = queries.op8_chat_formatting(spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        said = "".join(f"{a}\n{b}\n" for a, b in want[r.conv_id])
        loss = "".join(b for a, b in want[r.conv_id] if a == "assistant")
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(want[r.conv_id]), hashlib.sha256(said.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_pairs_are_learned():
    random = np.random.default_rng(4)
    good = random.normal(0, 1, (200, quality.FEATURES))
    bad = random.normal(0, 1, (100, quality.FEATURES))
    bad[:, 3] += 3
    model = quality.fit_pairs(good, bad)
    def raw(x):
        return (x - model.mean) @ model.weights
    bound = np.quantile(np.concatenate([raw(good), raw(bad)]), 1 / 3)
    assert (raw(good) > bound).mean() > 0.9 and (raw(bad) < bound).mean() > 0.85
    one_class = quality.fit_pairs(good, bad[:0])
    assert one_class.scores([b"any", b""]).tolist() == [0.5, 0.5]


def test_quality_holds_out_and_ranks(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in read(spark, sf_dir, "labels").collect()}
    got = queries.op7_pairwise_quality(spark, sf_dir).collect()
    documents = read(spark, sf_dir, "documents").count()
    assert len(got) == documents
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    unseen = [(r.score, r.predicted, labels[r.doc_id]) for r in got
              if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for _, p, q in unseen]) > 0.93
    good = np.array([s for s, _, q in unseen if q == 1])
    bad = np.array([s for s, _, q in unseen if q == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97


def test_quality_query_equals_its_definition(spark, sf_dir):
    """The weights are where the loss over the pairs, which is convex, has no slope; the threshold is the
    quantile of all scores that may be learned from; every score follows from both."""
    texts = {r.doc_id: (r.text or "").encode() for r in read(spark, sf_dir, "documents").collect()}
    known = {r.doc_id: r.quality for r in read(spark, sf_dir, "labels").collect()
             if r.quality is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    x = {i: quality.features(t) for i, t in texts.items()}
    good, bad = (np.array([x[i].astype(np.float32) for i in sorted(x) if known.get(i) == q], float)
                 for q in (1, 0))
    model = quality.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    both = np.concatenate([good, bad])
    spread = both.std(axis=0)
    scale = np.where(spread > 1e-4, 1 / np.maximum(spread, 1e-4), 0)
    random = np.random.default_rng(7)
    pairs = (good[random.integers(0, len(good), quality.PAIRS)]
             - bad[random.integers(0, len(bad), quality.PAIRS)]) * scale
    weights = np.divide(model.weights, scale, out=np.zeros(len(scale)), where=scale > 0)
    slope = quality.RIDGE * weights - pairs.T @ (1 / (1 + np.exp(pairs @ weights)))
    assert np.abs(slope).max() < 1e-4 * quality.PAIRS
    raw = {i: float((v - both.mean(axis=0)) @ model.weights) for i, v in x.items()}
    learned = np.array([raw[i] for i in sorted(x) if i in known])
    below = (learned < model.threshold).sum()
    # Counted in steps, so those within a step of the threshold may be on either side.
    near = (np.abs(learned - model.threshold) <= 2 / quality.STEPS).sum()
    assert abs(below - sum(known[i] == 0 for i in x if i in known)) <= near
    for r in queries.op7_pairwise_quality(spark, sf_dir).collect():
        want = 1 / (1 + np.exp(-np.clip(raw[r.doc_id] - model.threshold, -500, 500)))
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.5)


def test_quantile_steps():
    assert quality.quantile_step([5, 1, 9], [2, 3, 5], 0.3) == 3.5
    assert quality.quantile_step([5, 1, 9], [2, 3, 5], 0.5) == 7.5
    assert quality.quantile_step([4], [7], 0.2) == 5.0


def test_quality_awkward_rows(spark):
    docs = helpers.documents(spark)
    labels = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 0), (2, 0, 1), (3, None, 0), (None, 1, 0), (5, 1, None), (7, 0, 0),
         (9, 1, 0), (10, 0, 0), (11, 1, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == len(helpers.AWKWARD) and all(0 <= r.score <= 1 for r in got)
    kept = quality.accepted(docs, model)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert kept.count() == sum(r.predicted for r in got)
    unlabelled = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, unlabelled).collect()} == {0.5}
    assert quality.score(helpers.documents(spark, []), unlabelled).collect() == []


def test_quality_of_a_doc_id_with_different_texts(spark):
    one, two, three, four = [i for i in range(99) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    rows = [(one, "fine words"), (one, "!!!! ????"), (two, "fine words"), (three, "!?!?!"),
            (four, "more fine words")]
    labels = spark.createDataFrame([(one, 1), (two, 1), (three, 0), (four, 1)],
                                   "doc_id bigint, quality int")
    docs = helpers.documents(spark, rows)
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert sorted(r.doc_id for r in got) == [one, one, two, three, four]
    first, other = ({r.score for r in got if r.doc_id == i} for i in (two, one))
    assert first < other and len(other) == 2


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = helpers.documents(spark, [(i, f"text {i} " + "!?" [i % 2] * i) for i in range(60)])
    rows = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in rows]
    scores = [{r.doc_id: r.score for r in quality.score(docs, quality.fit(
        docs, spark.createDataFrame(r, "doc_id bigint, quality int"))).collect()}
        for r in (rows, turned)]
    assert scores[0] == scores[1]
