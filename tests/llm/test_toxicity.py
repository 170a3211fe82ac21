import math
import zlib
from collections import Counter, defaultdict

import numpy as np

from llm.helpers import AWKWARD, documents
from tillstream.llm import toxicity
from tillstream.llm.queries import op11_kneser_ney_toxicity


def symbols(text, order):
    return [0] * (order - 1) + [int(toxicity._SYMBOL[b]) for b in (text or "").encode()] + [0]


def plain_model(texts, classes, order):
    """Log-likelihood ratio of a text, by dictionaries; `without` takes a text's counts off its class."""
    counts = [Counter(), Counter()]
    types = defaultdict(set)
    for text, mark in zip(texts, classes, strict=True):
        s = symbols(text, order)
        for k in range(len(s) - order + 1):
            gram = tuple(s[k:k + order])
            types[order].add(gram)
            if mark is not None:
                counts[mark][gram] += 1
    for n in range(order, 1, -1):
        types[n - 1] = {g[1:] for g in types[n]}
    continued = {n: Counter(g[1:] for g in types[n + 1]) for n in range(1, order)}
    total1 = sum(c + 0.5 for c in (continued[1][(s,)] for s in range(toxicity.SYMBOLS)))

    def lower(gram):
        if len(gram) == 1:
            return (continued[1][gram] + 0.5) / total1
        same = {g: c for g, c in continued[len(gram)].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return lower(gram[1:])
        return (max(same.get(gram, 0) - toxicity.DISCOUNT, 0)
                + toxicity.DISCOUNT * len(same) * lower(gram[1:])) / total

    def chance(gram, of):
        same = {g: c for g, c in of.items() if g[:-1] == gram[:-1] and c > 0}
        total = sum(same.values())
        base = lower(gram[1:])
        if not total:
            return base
        return (max(same.get(gram, 0) - toxicity.DISCOUNT, 0)
                + toxicity.DISCOUNT * len(same) * base) / total

    def ratio(text, without=None):
        s = symbols(text, order)
        grams = [tuple(s[k:k + order]) for k in range(len(s) - order + 1)]
        of = [Counter(c) for c in counts]
        if without is not None:
            of[without].subtract(Counter(grams))
        return sum(math.log(chance(g, of[1]) / chance(g, of[0])) for g in grams) / len(grams)

    return ratio


def test_ratios_equal_plain_kneser_ney(spark):
    texts = ["you idiot, go away", "the cat sat", "a nice day é", "idiot clown", None, "the dog sat on",
             "idiot"]
    marks = [1, 0, 0, 1, 0, None, None]
    rows = list(enumerate(texts))
    known = spark.createDataFrame([(i, bool(m)) for i, m in enumerate(marks) if m is not None],
                                  "doc_id bigint, toxic boolean")
    for order in (2, 3):
        models = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), known, order)
        found = toxicity._Scorer(models).ratios([(t or "").encode() for t in texts])
        ratio = plain_model(texts, marks, order)
        for k, (text, mark) in enumerate(zip(texts, marks, strict=True)):
            assert found[k, 0] == np.float64(ratio(text)).round(12) or abs(
                found[k, 0] - ratio(text)) < 1e-9
            if mark is not None:
                assert abs(found[k, 1 + mark] - ratio(text, mark)) < 1e-9


def test_backoff_sums_to_one():
    seen = np.unique(toxicity.codes([b"some words, and some more"], 3)[0])
    backoff = toxicity.shared_backoff(seen, 3)
    assert backoff.shape == (toxicity.SYMBOLS**2,)
    np.testing.assert_allclose(backoff.reshape(-1, toxicity.SYMBOLS).sum(axis=1), 1)


def test_codes_stay_within_texts():
    texts = [b"ab", b"", b"c d"]
    found, starts = toxicity.codes(texts, 3)
    for k, text in enumerate(texts):
        alone, _ = toxicity.codes([text], 3)
        end = starts[k + 1] if k + 1 < len(texts) else len(found)
        assert found[starts[k]:end].tolist() == alone.tolist() and len(alone) == len(text) + 1


def test_logistic_splits_where_marks_do():
    ratio = np.array([-1.0, -0.5, 0.4, 0.6])
    slope, offset = toxicity.logistic(ratio, np.array([0.0, 0, 1, 1]), np.ones(4))
    assert ((ratio * slope + offset >= 0) == [False, False, True, True]).all()


def test_toxic_words_are_learned_from_the_rows_allowed(spark):
    draw = np.random.default_rng(11)
    plain = ["stone", "river", "walks", "under", "green", "light", "seven", "house"]
    rows, marks = [], []
    for i in range(600):
        words = draw.choice(plain, 30).tolist()
        if i % 4 == 0:
            words[5] = words[20] = "vexgrub" + str(draw.choice(["", "an", "is"]))
        rows.append((i, " ".join(words)))
        # Held-out rows are marked the wrong way round, which must not matter.
        wrong = zlib.crc32(str(i).encode()) % 5 == 0
        marks.append((i, int((i % 4 == 0) != wrong)))
    rows.append((1000, "river vexgrubon under green light stone"))
    scored = toxicity.score(documents(spark, rows), spark.createDataFrame(
        marks, "doc_id bigint, toxic int")).collect()
    found = {r["doc_id"]: r for r in scored}
    wrong = [i for i in range(600) if found[i]["predicted"] != int(i % 4 == 0)]
    assert len(wrong) < 6 and found[1000]["predicted"] == 1
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)


def test_every_byte_is_a_symbol_of_its_own(spark):
    alone = [toxicity.codes([bytes([b])], 3)[0][0] for b in range(256)]
    assert len(set(alone)) == 256
    # Texts of both classes that differ in a digit, a mark, a case or a letter beyond ASCII alone.
    pairs = [("b7b", "b3b"), ("w?", "w!"), ("Gnu", "gnu"), ("\u0430\u0431", "\u0430\u0441"), ("\xe9t", "\xf9t")]
    rows = [(i, f"river {pairs[i % 5][i // 5 % 2]} stone") for i in range(400)]
    marks = spark.createDataFrame([(i, i // 5 % 2) for i, _ in rows], "doc_id bigint, toxic int")
    found = toxicity.score(documents(spark, rows), marks).collect()
    assert [r["doc_id"] for r in found if r["predicted"] != r["doc_id"] // 5 % 2] == []


def test_scores_follow_the_ratio(spark, sf_dir):
    found = op11_kneser_ney_toxicity(spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)


def test_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (7, 1), (9, 0), (10, 1), (10, 0), (99, 1), (5, 0)],
        "doc_id bigint, toxic int").selectExpr("*", "'x' as text", "0 as score", "1 as code")
    found = toxicity.score(documents(spark), labels).collect()
    assert len(found) == len(AWKWARD)
    # Equal texts score alike.
    assert len({r["score"] for r in found if r["doc_id"] in (1, 5)}) == 1
    assert not any(r["held_out"] for r in found if r["doc_id"] is None)


def test_without_both_classes_or_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.score(
        documents(spark), labels).collect()} == {(0.0, 0)}
    assert toxicity.score(documents(spark, []), labels).collect() == []
    assert len(toxicity.score(documents(spark), labels.limit(0)).collect()) == len(AWKWARD)
