"""Links within groups of any size, against union-find, and how many rows they take."""

import numpy as np
import pytest

from tillstream.llm import linking


def comparer():
    """A function that travels to the workers by value, as they don't have this module."""

    def near_values(table, starts):
        """Members are alike if their values are at most one apart."""
        value, root = table.column("value").to_numpy(), table.column("root").to_numpy()
        found = []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(value)], strict=True):
            here, own = value[start:end], root[start:end]
            for member, reached in linking.spread(
                    end - start, lambda m, places, here=here: np.abs(here[places] - here[m]) <= 1, own):
                found.append((np.full(len(reached), own[member]), own[reached]))
        return found

    return near_values


def components(rows, roots):
    """Least root of each by plain union-find over all pairs of a group."""
    parent = {r: r for r in roots.values()}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for group, member, value in rows:
        for other_group, other, other_value in rows:
            if group == other_group and abs(value - other_value) <= 1:
                a, b = sorted((find(roots[member]), find(roots[other])))
                parent[b] = a
    return {r: find(r) for r in parent}


@pytest.mark.parametrize("seed,part", [(1, 3), (2, 5), (3, 1000)])
def test_components_equal_union_find(spark, seed, part):
    random = np.random.default_rng(seed)
    rows = [(int(random.integers(3)), m, int(random.integers(70))) for m in range(90)]
    # Some members are in one component before.
    roots = {m: m - m % 2 if m < 20 else m for _, m, _ in rows}
    frame = spark.createDataFrame([(g, m, roots[m], v) for g, m, v in rows],
                                  "grp bigint, member bigint, root bigint, value bigint")
    joined = {r.root: r.joined for r in linking.linked(
        frame, ["grp"], comparer(), part).collect()}
    want = components(rows, roots)
    assert {r: joined.get(r, r) for r in want} == want


def test_a_tight_group_is_dealt_out_twice_at_most(spark):
    """One cell of 100,000 members that are nearly all alike."""
    n, part = 100_000, 2048
    rows = spark.range(n).selectExpr("1L as band", "id as member", "id as root", "id % 50000 as value")
    large = spark.createDataFrame([(1, 0, -(-n // part))], "band bigint, pivot bigint, parts int")
    first = linking._everything(rows, large, ["band"])
    assert first.count() == n + -(-n // part) - 1
    assert first.groupBy("first_part").count().agg({"count": "max"}).first()[0] < 1.3 * part
    # After that, all but a few are in one component.
    joined = rows.selectExpr("band", "member", "if(member % 10000 = 7, member, 0L) as root", "value")
    second = linking.leftovers(joined, large, ["band"], part)
    assert second.count() <= 1.01 * n
    sizes = second.groupBy("first_part", "second_part").count().agg({"count": "max"}).first()[0]
    assert sizes < 1.3 * part + 20


def test_left_overs_meet_all_of_another_component(spark):
    rows = [(m, 0 if m < 30 else m) for m in range(45)]
    frame = spark.createDataFrame(rows, "member bigint, root bigint").selectExpr("1L as band", "*")
    large = spark.createDataFrame([(1, 0, 9)], "band bigint, pivot bigint, parts int")
    tasks = {}
    for r in linking.leftovers(frame, large, ["band"], 4).collect():
        tasks.setdefault((r.first_part, r.second_part), set()).add(r.member)
    together = {(a, b) for members in tasks.values() for a in members for b in members}
    root = dict(rows)
    assert all((a, b) in together for a in root for b in root if root[a] != root[b])


def test_forest_spans_its_links():
    random = np.random.default_rng(5)
    a, b = random.integers(0, 60, 300), random.integers(0, 60, 300)
    left, right = linking.forest(a, b)
    assert len(left) == len(np.unique(np.concatenate([a, b]))) - 1


def test_nothing_to_link(spark):
    empty = spark.createDataFrame([], "band bigint, member bigint, root bigint, value bigint")
    assert linking.linked(empty, ["band"], comparer(), 10).collect() == []
