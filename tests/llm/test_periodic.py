import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np

from llm.helpers import AWKWARD, LONG, documents, rows_of
from tillstream.llm import periodic
from tillstream.llm.queries import op13_grammar_runs, repeated_end


def plain_runs(words):
    """Every period by itself, over the whole text."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(6, 4 * q) and not any(
                    all(words[k] == words[k + d] for k in range(start, end - d))
                    for d in range(1, q) if q % d == 0):
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(draw, most=90):
    kinds, out = draw.choice([1, 2, 2, 3, 5]), []
    length = draw.randint(0, most)
    while len(out) < length:
        out += [draw.randrange(kinds) for _ in range(draw.randint(1, 7))] * draw.randint(1, 7)
        if draw.random() < 0.3:
            out += [draw.randrange(kinds + 2) for _ in range(draw.randint(0, 5))]
        if draw.random() < 0.2:
            out += out[-draw.randint(1, 30):]
    return out


def test_runs_equal_brute_force():
    draw = random.Random(13)
    for _ in range(600):
        texts = [random_words(draw) for _ in range(draw.randint(1, 4))]
        found = periodic.runs([np.array(t, np.int64) for t in texts])
        assert found == [plain_runs(t) for t in texts]


def test_grammar_derives_its_texts():
    draw = random.Random(1)
    for _ in range(200):
        texts = [t for t in (random_words(draw) for _ in range(3)) if t]
        grammar = periodic.Grammar(texts)

        def derived(symbol, grammar=grammar):
            if symbol < grammar.first_rule:
                return [symbol]
            left, right = grammar.rules[symbol - grammar.first_rule]
            return derived(left) + derived(right)

        assert [[w for s in sequence for w in derived(s)] for sequence in grammar.sequences] == texts
        pairs = [p for s in grammar.sequences for p in zip(s, s[1:], strict=False)]
        # No pair is left twice, but for overlaps within a repeated symbol.
        assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_long_repetitions_take_no_square_time():
    for unit, times, tail in (([0], 200_000, [1]), ([0, 1, 2], 60_000, [3]), ([0, 0, 1], 50_000, [])):
        text = np.array(unit * times + tail, np.int64)
        found, = periodic.runs([text])
        whole = (0, len(unit) * times, len(unit))
        assert whole in found and all(r == whole or r[1] < 10 for r in found)


def plain_digest(doc_id, text):
    words = repeated_end(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_on_the_table(spark, sf_dir):
    # Brute force takes the square of a text's length, so the longest are left to the tests above.
    rows = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
            if len(r["text"] or "") < 6000]
    found = {r["doc_id"]: tuple(r[c] for c in (
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256")) for r in op13_grammar_runs(spark, sf_dir).collect()}
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert [found[r["doc_id"]] for r in rows] == [plain_digest(r["doc_id"], r["text"]) for r in rows]


def test_repeated_end():
    words = [b"%d" % k for k in range(50)]
    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert repeated_end(doc_id, words) == [
        w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    assert repeated_end(None, words) == words and repeated_end(doc_id, []) == []


def test_awkward_rows(spark):
    rows = [*AWKWARD, (20, "ha " * 5), (21, "ha\t" * 6), (22, "a b a b\na b a b c"), (23, "x " + "a b " * 4)]
    found = rows_of(periodic.find_runs(documents(spark, rows)))
    shown = {r[0]: r[1:] for r in found if r[0] is not None}
    nothing = (0, None, None, None, None, "")
    assert len(found) == len(rows)
    assert shown[2] == shown[3] == shown[4] == (*nothing, "")
    assert shown[20] == (*nothing, "ha ha ha ha ha")
    assert shown[21] == (1, 0, 6, 1, 6000, "0,6,1\n", "ha")
    assert shown[22] == (1, 0, 8, 2, 4000, "0,8,2\n", "a b c")
    assert shown[23] == (1, 1, 8, 2, 4000, "1,8,2\n", "x a b")
    assert shown[9] == (1, 0, 90_000, 3, 30_000_000, "0,90000,3\n", "lorem ipsum dolor")
    assert shown[10][0] == 1 and shown[10][-1] == "lorem ipsum dolor end"
    assert len(LONG.split()) == 90_000


def test_empty(spark):
    assert rows_of(periodic.find_runs(documents(spark, []))) == []
