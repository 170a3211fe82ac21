"""Longest-first shards and separator scans."""

import zlib
from collections import defaultdict

import helpers
import numpy as np
import pytest
from tokenizers import Tokenizer

from tillstream.llm import queries, shards, tokens
from tillstream.llm.common import read


def test_longest_first_is_the_plain_greedy():
    sizes = [7, 5, 5, 3, 3, 3, 1, 1]
    loads, want = [0, 0, 0], []
    for size in sizes:
        shard = loads.index(min(loads))
        loads[shard] += size
        want.append(shard)
    assert shards.longest_first(sizes, 3) == want
    assert shards.longest_first([], 3) == []


def _check_shards(rows, texts, count):
    """rows: (doc_id, size, crc, shard, slot)."""
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for doc_id, size, crc, shard, slot in rows:
        by_shard[shard].append((slot, size))
    for found in by_shard.values():
        assert sorted(s for s, _ in found) == list(range(len(found)))
    for doc_id, size, crc, shard, _ in rows:
        if doc_id in texts:
            text = (texts[doc_id] or "").encode()
            assert (size, crc) == (len(text) + 1, zlib.crc32(text))
            by_text[text].add(shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(0 <= shard < count for shard in by_shard)


def test_awkward_rows_are_placed(spark):
    out = helpers.rows_of(shards.place(helpers.documents(spark), 4))
    assert len(out) == len(helpers.AWKWARD)
    _check_shards(out, {i: t for i, t in helpers.AWKWARD if i is not None}, 4)


def test_a_group_of_a_third_of_all_rows_stays_together(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"text {i}") for i in range(600)]
    out = helpers.rows_of(shards.place(helpers.documents(spark, rows), 4))
    _check_shards(out, dict(rows), 4)


def test_whole_table_is_near_equal(spark, sf_dir):
    out = queries.op1_longest_first_shards(spark, sf_dir)
    got = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in out.collect()]
    texts = {r.doc_id: r.text for r in read(spark, sf_dir, "documents").collect()}
    assert len(got) == len(texts)
    _check_shards(got, texts, 16)
    loads = defaultdict(int)
    for _, size, _, shard, _ in got:
        loads[shard] += size
    assert len(loads) == 16
    assert max(loads.values()) - min(loads.values()) <= max(s for _, s, *_ in got)


def test_no_rows(spark):
    empty = helpers.documents(spark, [])
    assert helpers.rows_of(shards.place(empty, 4)) == []


def _blocks(spark, files, cut, width="<u2"):
    rows = []
    for file, ids in files.items():
        data = np.array(ids, width).tobytes()
        size = cut * np.dtype(width).itemsize
        rows += [(file, k, bytearray(data[i:i + size]))
                 for k, i in enumerate(range(0, len(data), size))]
    return spark.createDataFrame(rows, tokens.BLOCKS)


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_scan_equals_a_plain_split(spark, cut, width, monkeypatch):
    monkeypatch.setattr(tokens, "SPAN", 4)
    random = np.random.default_rng(cut)
    files = {f: random.integers(0, 4, 60 + f).tolist() for f in range(3)}
    files[3] = [0, 0, 0]
    files[4] = [1, 2, 3]
    want = set()
    for file, ids in files.items():
        start = ordinal = 0
        for place, number in enumerate(ids):
            if number == 0:
                want.add((file, ordinal, start, place - start, True))
                start, ordinal = place + 1, ordinal + 1
        if start < len(ids):
            want.add((file, ordinal, start, len(ids) - start, False))
    found = tokens.search(_blocks(spark, files, cut, f"<u{width}"), 0, width)
    got = helpers.rows_of(tokens.count_tokens(found).select(
        "file", "ordinal", "start", "n_tokens", "ended"))
    assert len(got) == len(want) and set(got) == want


def test_scan_takes_nulls_and_no_rows(spark):
    blocks = spark.createDataFrame([(None, 0, bytearray(b"\1\0\0\0")), (1, 0, None)], tokens.BLOCKS)
    got = helpers.rows_of(tokens.count_tokens(tokens.search(blocks, 0)))
    assert [r[:5] for r in got] == [(None, 0, 0, 1, True)]
    assert helpers.rows_of(tokens.count_tokens(tokens.search(blocks.limit(0), 0))) == []


@pytest.mark.parametrize("width", [2, 4])
def test_written_files_are_found_again(spark, width):
    docs = helpers.documents(spark)
    files = tokens.write_blocks(docs, queries.WORD_BPE, queries.END_OF_DOCUMENT, 16, width)
    assert max(len(r.data) for r in files.collect()) == 16 * width
    got = tokens.count_tokens(tokens.search(files, queries.END_OF_DOCUMENT, width))
    plain = Tokenizer.from_file(queries.WORD_BPE)
    plain.encode_special_tokens = True
    want = sorted(len(plain.encode(t or "", add_special_tokens=False).ids)
                  for _, t in helpers.AWKWARD)
    assert sorted(r.n_tokens for r in got.collect()) == want


def test_query_counts_every_document(spark, sf_dir):
    plain = Tokenizer.from_file(queries.WORD_BPE)
    plain.encode_special_tokens = True
    want = {r.doc_id: len(plain.encode(r.text or "", add_special_tokens=False).ids)
            for r in read(spark, sf_dir, "documents").collect()}
    got = queries.op2_separator_token_counts(spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(want)
