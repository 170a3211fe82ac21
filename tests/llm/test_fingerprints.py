"""Fingerprints, their search, and edits with the next document."""

import hashlib

import helpers
import numpy as np
import pytest

from tillstream.llm import fingerprints, queries
from tillstream.llm.common import read


def test_search_equals_brute_force(spark):
    random = np.random.default_rng(3)
    prints = []
    for _ in range(60):
        one = int.from_bytes(random.bytes(16))
        prints.append(one)
        for flips in (1, 3, 4):
            bits = random.choice(128, flips, replace=False)
            prints.append(one ^ sum(1 << int(b) for b in bits))
    names = [f"{p:032x}" for p in prints]
    frame = spark.createDataFrame([(n,) for n in names + names[:10]], "fingerprint string")
    asked = frame.limit(40)
    wanted = {(a, b, (int(a, 16) ^ int(b, 16)).bit_count())
              for a in {r[0] for r in asked.collect()} for b in names
              if (int(a, 16) ^ int(b, 16)).bit_count() <= 3}
    for blocks in (4, 5, 6):
        got = helpers.rows_of(fingerprints.within_radius(asked, frame, 3, blocks))
        assert len(got) == len(wanted) and set(got) == wanted


@pytest.mark.parametrize("part", [3, 2048])
@pytest.mark.parametrize("blocks", [4, 5])
def test_counts_equal_brute_force(spark, blocks, part):
    random = np.random.default_rng(blocks)
    prints = {0, 1, 3, (1 << 128) - 1, (1 << 128) - 2, 1 << 127, 1 << 64, 1 << 63}
    for _ in range(30):
        one = int.from_bytes(random.bytes(16))
        for flips in (0, 1, 1, 2, 3, 4):
            prints.add(one ^ sum(1 << int(b) for b in random.choice(128, flips, replace=False)))
    frame = spark.createDataFrame([(f"{p:032x}",) for p in prints] * 2, "fingerprint string")
    got = dict(helpers.rows_of(fingerprints.count_within_radius(frame, 3, blocks, part)))
    want = {f"{a:032x}": sum(0 < (a ^ b).bit_count() <= 3 for b in prints) for a in prints}
    assert got == {k: n for k, n in want.items() if n}


def test_hot_copies_cost_one_entry(spark):
    frame = spark.createDataFrame([("0" * 32,)] * 500, "fingerprint string")
    assert helpers.rows_of(fingerprints.within_radius(frame, frame)) == [("0" * 32, "0" * 32, 0)]


def _brute(rows):
    def key(row):
        return (row[0] is not None, row[0] or 0)
    ordered = sorted(((i, t or "") for i, t in rows), key=key)
    out = {}
    for k, (doc_id, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        out[doc_id] = (len(text), hashlib.sha256(edited.encode()).hexdigest(),
                       fingerprints.simhash(text.encode()).hex(),
                       fingerprints.simhash(edited.encode()).hex(), following)
    return out


def test_whole_table_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    want = _brute(rows)
    got = queries.op3_simhash_fingerprints(spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        n_chars, sha, own, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (
            n_chars, sha, own, edited)
        other = fingerprints.simhash(following.encode())
        assert r.near_next == fingerprints.likeness(bytes.fromhex(own), other)
        assert r.near_edited == fingerprints.likeness(bytes.fromhex(own), bytes.fromhex(edited))
    prints = {int(r.fingerprint, 16) for r in got}
    for r in got[:50]:
        mine = int(r.fingerprint, 16)
        assert r.n_within_radius == sum(0 < (mine ^ p).bit_count() <= 3 for p in prints)
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.15


def test_awkward_rows(spark):
    rows = [(i, t) for i, t in helpers.AWKWARD if i not in (None, 7)] + [(None, "no id")]
    got = fingerprints.compare_with_edits(helpers.documents(spark, rows)).collect()
    want = _brute(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {
        i: w[:2] for i, w in want.items()}
    assert len(fingerprints.compare_with_edits(helpers.documents(spark)).collect()) == len(
        helpers.AWKWARD)
    one = fingerprints.compare_with_edits(helpers.documents(spark, [(1, "a b c d")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(1, 1.0)]
    assert fingerprints.compare_with_edits(helpers.documents(spark, [])).collect() == []
    equal = fingerprints.fingerprints(helpers.documents(spark)).collect()
    prints = {r.doc_id: r.fingerprint for r in equal}
    assert prints[1] == prints[5] == prints[6] and prints[2] == prints[3] == "0" * 32
