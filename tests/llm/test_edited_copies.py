"""Near-duplicates with real edits, against exact shingle similarity."""

import corpus_pipeline
import helpers
import numpy as np
import pytest

from tillstream.llm import edited_copies


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def _similarity(one, other):
    one, other = _shingles(one), _shingles(other)
    return len(one & other) / len(one | other)


def planted(similarity, pairs, seed=3, first_id=0):
    """Pairs of texts of random words, the second edited down to about this similarity."""
    random, rows = np.random.default_rng(seed), []
    for k in range(pairs):
        words = [f"w{x}" for x in random.integers(0, 50_000, random.integers(100, 1000))]
        edited = list(words)
        # Each changed word alone takes five shingles on either side.
        want = (1 - similarity) / (1 + similarity) * len(words) / 5
        for at in random.permutation(len(words) // 5)[:max(1, round(want))]:
            edited[at * 5 + 2] = f"edit{random.integers(1 << 40)}"
        rows += [(first_id + 2 * k, " ".join(words)), (first_id + 2 * k + 1, " ".join(edited))]
    return rows


def test_edited_copies_go(spark, sf_dir):
    rows = (planted(0.83, 60) + planted(0.91, 60, 4, 1000) + planted(0.97, 60, 5, 2000)
            + planted(0.6, 60, 6, 3000))
    text = dict(rows)
    stage = dict(corpus_pipeline.STAGES)["near dedup"]
    left = {r.doc_id for r in stage(spark, helpers.documents(spark, rows), sf_dir).collect()}
    copies = {i for i in text if i % 2 and _similarity(text[i - 1], text[i]) >= 0.8}
    assert len(copies) >= 170
    assert not set(text) - left - copies
    assert len(copies & left) <= 0.03 * len(copies)


@pytest.mark.parametrize("part", [4, 2048])
def test_components_equal_brute_force(spark, part, monkeypatch):
    monkeypatch.setattr(edited_copies.links, "__defaults__", (5, 0.8, part))
    monkeypatch.setattr(edited_copies.candidates, "__defaults__", (part,))
    rows = list(helpers.AWKWARD)
    # A chain: neighbours are similar, its ends are not.
    words = [f"c{k}" for k in range(200)]
    for k in range(30):
        words[(k * 7) % 200] = f"new{k}"
        rows.append((200 - k, " ".join(words)))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, one) in enumerate(rows):
        for j, (_, other) in enumerate(rows[:i]):
            if _similarity(one, other) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    want = [(d, least.get(find(i))) for i, (d, _) in enumerate(rows)]
    got = edited_copies.components(helpers.documents(spark, rows)).select("doc_id", "component_id")
    assert sorted(helpers.rows_of(got), key=str) == sorted(want, key=str)


def test_a_doc_id_with_different_texts(spark):
    words = [f"w{k}" for k in range(300)]
    edited = [*words[:200], "new", *words[201:]]
    rows = [(5, " ".join(words)), (5, "some other text of more than five words"), (3, " ".join(edited)),
            (9, "some other text of more than five words")]
    got = edited_copies.components(helpers.documents(spark, rows))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(3, 3), (5, 3), (5, 5), (9, 5)]


def test_bit_counts_of_segments_find_what_no_stretch_of_bits_shares(spark):
    random = np.random.default_rng(8)
    one = random.integers(0, 2, edited_copies.BITS)
    # The bits of one segment in every stretch of 16 are swapped: no stretch stays, all counts do.
    one[::16], one[1::16] = 0, 1
    swapped, near, far = one.copy(), one.copy(), random.integers(0, 2, edited_copies.BITS)
    swapped[::16], swapped[1::16] = 1, 0
    near[random.permutation(edited_copies.BITS)[:31]] ^= 1
    prints = [(k, np.packbits(bits).view(np.int64).tolist())
              for k, bits in enumerate((one, swapped, near, far))]
    found = edited_copies.candidates(spark.createDataFrame(prints, "set_key bigint, print array<bigint>"))
    root = dict(map(tuple, found.collect()))
    assert root[0] == root[1] == root[2] != root[3]


def test_no_rows(spark):
    assert edited_copies.components(helpers.documents(spark, [])).collect() == []
