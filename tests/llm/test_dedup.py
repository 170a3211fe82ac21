"""Exact, near and substring dedup against brute force."""

import hashlib
import re

import helpers
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstream.llm import exact_dedup, graph, near_dedup, queries, substrings
from tillstream.llm.common import read

_SPACE = re.compile(r"[\x20\x09-\x0D]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**56 - 1), min_size=1, max_size=300), st.integers(0, 56))
def test_rice_round_trip(values, shift):
    numbers = np.unique(np.array([v >> shift for v in values], np.uint64))
    assert (exact_dedup.rice_decode(exact_dedup.rice_encode(numbers)) == numbers).all()


def test_rice_is_smaller_than_the_numbers():
    numbers = np.unique(np.random.default_rng(1).integers(0, 2**40, 50_000).astype(np.uint64))
    assert len(exact_dedup.rice_encode(numbers)) < 0.5 * 8 * len(numbers)


def _exact(rows):
    groups = {}
    for doc_id, text in rows:
        text = text or ""
        groups.setdefault(_SPACE.sub("", text), []).append((-len(text), doc_id is None, doc_id))
    out = set()
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out |= {(m[2], keep, len(members), m[2] == keep, sha) for m in members}
    return out


@pytest.mark.parametrize("owners,bound", [(1, 0), (3, 0), (3, 10**6)])
def test_exact_awkward_rows(spark, owners, bound, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_SUSPECTS", bound)
    out = exact_dedup.deduplicate(helpers.documents(spark), owners)
    got = helpers.rows_of(out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
    assert len(got) == len(helpers.AWKWARD) and set(got) == _exact(helpers.AWKWARD)


def test_exact_negative_and_extreme_ids(spark):
    rows = [(-5, "a b"), (3, "ab"), (-2**63, "ab"), (2**63 - 1, "ab "), (0, "a b"), (None, "a b")]
    out = exact_dedup.deduplicate(helpers.documents(spark, rows))
    got = helpers.rows_of(out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
    assert set(got) == _exact(rows) and len(got) == len(rows)


def test_exact_blocks_are_cut(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK_DOCUMENTS", 3)
    rows = [(i, f"text {i % 7}") for i in range(40)]
    out = exact_dedup.deduplicate(helpers.documents(spark, rows), 4)
    got = helpers.rows_of(out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
    assert set(got) == _exact(rows) and len(got) == len(rows)


def test_exact_no_rows(spark):
    assert exact_dedup.deduplicate(helpers.documents(spark, [])).collect() == []


def _simhash(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = _WORD.findall(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(pairs):
    """(doc_id, print) to (doc_id, hex, component)."""
    prints = sorted({p for _, p in pairs})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for doc_id, p in pairs:
        if doc_id is not None:
            least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return sorted(((d, f"{p:016x}", least.get(find(p))) for d, p in pairs), key=str)


def test_near_awkward_rows(spark):
    got = near_dedup.components(helpers.documents(spark)).drop("text_key")
    assert sorted(helpers.rows_of(got), key=str) == _components(
        [(i, _simhash(t or "")) for i, t in helpers.AWKWARD])


def test_a_doc_id_with_different_texts(spark):
    """Each row counts by its own text."""
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(1, passage), (1, "quite another text with words of its own"), (2, passage),
            (2, passage + " and more"), (3, "quite another text with words of its own")]
    near = near_dedup.components(helpers.documents(spark, rows)).drop("text_key")
    assert sorted(helpers.rows_of(near), key=str) == _components(
        [(i, _simhash(t)) for i, t in rows])
    removed = substrings.remove_repeats(helpers.documents(spark, rows))
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in removed.collect()) == [
        (1, 8, 0, rows[1][1]), (1, 60, 0, passage), (2, 60, 60, ""), (2, 62, 60, "and more"),
        (3, 8, 0, rows[4][1])]
    exact = exact_dedup.deduplicate(helpers.documents(spark, rows))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in exact.collect()} == {
        (1, 1, 2), (2, 1, 2), (2, 2, 1), (3, 1, 2)}


def test_near_whole_table(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").collect()
    want = _components([(r.doc_id, near_dedup.simhash((r.text or "").encode())) for r in rows])
    got = helpers.rows_of(queries.op6_simhash_near_dedup(spark, sf_dir))
    assert sorted(got, key=str) == want
    for r in rows[:25]:
        assert near_dedup.simhash(r.text.encode()) == _simhash(r.text)


@pytest.mark.parametrize("part", [4, 2048])
def test_links_connect_what_brute_force_connects(spark, part):
    random = np.random.default_rng(5)
    prints = set()
    for _ in range(12):
        one = int.from_bytes(random.bytes(8))
        chain = one
        for _ in range(10):
            for bit in random.choice(64, random.integers(1, 4), replace=False):
                chain ^= 1 << int(bit)
            prints.add(chain)
        prints |= {one ^ (1 << int(b)) for b in random.choice(64, 8, replace=False)}
    prints |= {0, 1, 2**63, 2**64 - 1, 2**64 - 2}
    signed = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    frame = spark.createDataFrame(signed, "print bigint")
    links = helpers.rows_of(near_dedup.links(frame, 3, part))
    names = {s[0]: p for s, p in zip(signed, prints, strict=True)}
    assert all((names[a] ^ names[b]).bit_count() <= 3 for a, b in links)
    found = helpers.rows_of(graph.roots(spark.createDataFrame(links, "a bigint, b bigint")))
    root = {k: k for k in names} | dict(found)
    want = _components(list(enumerate(prints)))
    least = {}
    for name, p in names.items():
        least.setdefault(root[name], set()).add(p)
    by_component = {}
    for _, text, component in want:
        by_component.setdefault(component, set()).add(int(text, 16))
    assert sorted(map(sorted, least.values())) == sorted(map(sorted, by_component.values()))


def test_near_no_rows(spark):
    assert near_dedup.components(helpers.documents(spark, [])).collect() == []


def test_roots_of_chains_stars_and_loops(spark):
    links = ([(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
             + [(7, 7), (None, 3), (200, 199), (199, 200)])
    got = dict(helpers.rows_of(graph.roots(spark.createDataFrame(links, "a bigint, b bigint"))))
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 130)} | {200: 199}
    assert got == want
    empty = spark.createDataFrame([], "a bigint, b bigint")
    assert graph.roots(empty).collect() == []


def test_few_links_need_no_round(spark, monkeypatch):
    """The driver plans one query that writes, whatever the shape of the links."""
    written, write = [], graph.stored_at
    monkeypatch.setattr(graph, "stored_at", lambda df, name: written.append(name) or write(df, name))
    links = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1300)] + [(300, 5)]
    got = dict(helpers.rows_of(graph.roots(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert got == {i: 0 for i in range(1, 301)} | {i: 1000 for i in range(1001, 1300)}
    assert len(written) == 1


@pytest.mark.parametrize("rows", [1, 7, 50])
def test_roots_of_links_of_many_tasks(spark, rows, monkeypatch):
    monkeypatch.setattr(graph._flattened, "__defaults__", (rows,))
    monkeypatch.setattr(graph, "_flattened", lambda links, f=graph._flattened: f(
        links.repartition(5, "low")))
    random = np.random.default_rng(rows)
    links = random.integers(-200, 200, (260, 2)).tolist() + [(300 + i, 301 + i) for i in range(40)]
    parent = {}

    def find(x):
        while x in parent:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        if low != high:
            parent[high] = low
    got = helpers.rows_of(graph.roots(spark.createDataFrame(links, "a bigint, b bigint")))
    assert len(got) == len(dict(got))
    assert dict(got) == {k: find(k) for k in parent}


def _removed(rows, window):
    first = {}
    for doc_id, text in rows:
        words = _WORD.findall(text or "")
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = _WORD.findall(text or "")
        gone = set()
        if doc_id is not None:
            for i in range(len(words) - window + 1):
                if first[tuple(words[i:i + window])] < doc_id:
                    gone |= set(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        out.append((doc_id, len(words), len(gone), " ".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [20_000, 3, 1])
@pytest.mark.parametrize("window", [5, 9])
def test_substrings_equal_brute_force(spark, window, hot, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_RUNS", hot)
    random = np.random.default_rng(window)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = []
    for doc_id in range(80):
        words = [f"w{k}" for k in random.integers(0, 6, random.integers(0, 40))]
        if doc_id % 3:
            words.insert(len(words) // 2, passage)
        rows.append((doc_id, " ".join(words)))
    rows += [(90, rows[5][1]), (90, rows[5][1]), (None, rows[5][1]), (91, None), (92, "")]
    got = substrings.remove_repeats(helpers.documents(spark, rows), window)
    assert sorted(helpers.rows_of(got), key=str) == _removed(rows, window)


def test_substring_buckets_are_cut(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_WORDS", 4)
    rows = [(i, " ".join(f"w{(i // 2 * 31 + k) % 50}" for k in range(30))) for i in range(40)]
    got = substrings.remove_repeats(helpers.documents(spark, rows), 10)
    assert sorted(helpers.rows_of(got), key=str) == _removed(rows, 10)


def test_substring_awkward_rows(spark):
    short = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t in helpers.AWKWARD]
    got = substrings.remove_repeats(helpers.documents(spark, short), 5)
    assert sorted(helpers.rows_of(got), key=str) == _removed(short, 5)
    assert substrings.remove_repeats(helpers.documents(spark, [])).collect() == []


def test_cleaned_keeps_columns_and_untouched_texts(spark):
    docs = helpers.documents(spark)
    out = substrings.cleaned(docs, 5)
    assert out.schema.simpleString() == docs.schema.simpleString()
    by_id = {}
    for r in out.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].text == helpers.AWKWARD[0][1] and by_id[5][0].text == ""
    assert by_id[5][0].n_chars == 0 and by_id[2][0].text is None and by_id[4][0].text == " \t\n"


def test_substrings_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    want = sorted(((d, n, g, hashlib.sha256(k.encode()).hexdigest())
                   for d, n, g, k in _removed(rows, 50)), key=str)
    got = sorted(helpers.rows_of(queries.op4_super_kmer_substrings(spark, sf_dir)), key=str)
    assert got == want
