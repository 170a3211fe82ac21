import numpy as np
import pytest

from llm.helpers import rows_of
from tillstream.llm import whitening
from tillstream.llm.queries import op12_bit_sliced_whitening

RANDOM = np.random.default_rng(12)


def plain(vectors, components=4):
    """Whitening by sums of products of whole numbers."""
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for v in vectors], object)
    fit = np.array([list(map(int, v)) for v in sorted({tuple(v) for v in x})], object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = n * fit - sums
    covariance = (centred.T.dot(centred) / n**3).astype(float)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    whitened = (n * x - sums).astype(float) / n @ vectors[:, order] / np.sqrt(values[order])
    return n, deviations, whitened, values[order] / values.sum()


def compare(frame, vectors, keys):
    n, deviations, whitened, explained = plain(vectors)
    found = {(r["vec_id"], r["component"]): r for r in frame.collect()}
    assert len(found) == len(keys) * len(explained)
    for k in range(len(explained)):
        rows = [found[key, k + 1] for key in keys]
        got = np.array([r["whitened"] for r in rows])
        sign = np.sign(got @ whitened[:, k])
        np.testing.assert_allclose(got * sign, whitened[:, k], rtol=1e-7, atol=1e-9)
        assert all(int(r["deviation"]) == d for r, d in zip(rows, deviations, strict=True))
        assert {r["n"] for r in rows} == {n}
        assert rows[0]["explained"] == pytest.approx(explained[k], rel=1e-9)
        assert 0 <= rows[0]["identity_error"] < 1e-8


def test_scatter_equals_products():
    for widths in ([3, 1, 7], [62, 5], [1]):
        x = np.stack([RANDOM.integers(0, 1 << w, 200) for w in widths], axis=1)
        expected = x.astype(object).T.dot(x.astype(object))
        found = whitening.scatter(x, widths)
        assert [[expected[i, j] for j in range(i, len(widths))] for i in range(len(widths))] == found


def test_scatter_over_blocks(monkeypatch):
    monkeypatch.setattr(whitening, "_ROWS", 100)
    x = RANDOM.integers(0, 300, (333, 4))
    expected = x.T @ x
    assert [row[0] for row in whitening.scatter(x, [9] * 4)] == np.diag(expected).tolist()


def test_query_on_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    compare(op12_bit_sliced_whitening(spark, sf_dir), [r["embedding"] for r in table],
            [r["vec_id"] for r in table])


def test_copies_count_once_and_wide_ranges_are_exact(spark):
    vectors = [[float(v) for v in row] for row in RANDOM.normal(0, 3, (60, 5))]
    vectors += [vectors[0]] * 40 + [[5e3, -2.5e4, 3.0, 0.0, -0.0]]
    rows = list(enumerate(vectors))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(7)
    compare(whitening.whiten(frame), vectors, range(len(rows)))


def test_deviations_of_many_rows():
    """The sums of a large fit list need several digits."""
    sums = [3 * 10**14, 7, 10**15 + 3]
    model = whitening.Whitening(256, 10**12, [-5, 0, 2], [10, 3, 9], sums, np.eye(3), np.ones(3), 3.0)
    x = np.array([[100, 3, 400], [-5, 0, 2], [1018, 7, 513]])
    centred = 10**12 * (x.astype(object) - np.array([-5, 0, 2], object)) - np.array(sums, object)
    assert model.deviations(x) == (centred**2).sum(axis=1).tolist()
    np.testing.assert_allclose(model.whitened(x), (centred / 10**12).astype(float), rtol=1e-12)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [0.5, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []),
            (7, [1.0, 2.0, 3.0]), (8, [0.25, -1.0]), (8, [0.25, -1.0]), (None, [0.75, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "1 as n", "2 as component", "3 as packed", "'x' as key", "4 as vector")
    found = whitening.whiten(frame).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in found) == sorted(
        (key is None, key or 0, c) for key in (1, 8, 8, None) for c in (1, 2))
    assert {r["n"] for r in found} == {3}


def test_no_variance_and_huge_entries(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])],
                                 "vec_id bigint, embedding array<double>")
    assert {(r["whitened"], r["explained"], int(r["deviation"]), r["identity_error"])
            for r in whitening.whiten(same).collect()} == {(None, 0.0, 0, 0.0)}
    huge = spark.createDataFrame([(1, [1e300, -1e300]), (2, [0.0, 0.0]), (3, [-1e300, 5.0])],
                                 "vec_id bigint, embedding array<double>")
    assert len(whitening.whiten(huge).collect()) == 6


def test_empty(spark):
    for rows in ([], [(1, None), (2, [])]):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
        assert rows_of(whitening.whiten(frame)) == []
