"""Connected components of links between 64-bit keys, by alternating large and small stars.

First the links of every task are flattened among themselves, so few links, which come in one task,
need no round. Every round rewires each key to the least key it knows, with two groupings that
pre-aggregate and two joins whose hot side adaptive execution can split; no key's neighbours are ever
collected. Rounds grow with the logarithm of the longest chain. They end as soon as the links are stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, stored_at
from tillstream.session import remove

# Links flattened at once.
TABLE_ROWS = 1 << 18


def _stars_of(table: pa.Table) -> pa.RecordBatch:
    """Every key that is linked to a lesser one in the table, with the least key it is connected to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for a, b in zip(*(table.column(c).to_pylist() for c in ("high", "low")), strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(parent), pa.int64()), pa.array([find(k) for k in parent], pa.int64())],
        schema=table.schema)


def _flattened(links: DataFrame, rows: int = TABLE_ROWS) -> DataFrame:
    """Links that connect the same keys; those that a task reads together are stars."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= rows:
                # Stars are fewer than the links; they go on with the next ones, if they left room.
                stars = _stars_of(pa.Table.from_batches(held))
                held = [stars] if 2 * stars.num_rows < rows else []
                if not held:
                    yield stars
        if held:
            yield _stars_of(pa.Table.from_batches(held))

    return arrow_map(links, flat, "high bigint, low bigint").distinct()


def _all_stars(links: DataFrame) -> bool:
    """Whether every key has one lesser key at most, and those that have one are nobody's lesser key."""
    ends = links.select("low", F.explode(F.array("high", "low")).alias("key"))
    return ends.groupBy("key").agg(F.min("low").alias("least"), F.max("low").alias("most")).where(
        "least < most").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a key go to the least of the key and its neighbours."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("root"))
    least = least.select("high", F.least("high", "root").alias("root"))
    return (both.where("low > high").join(least, "high")
            .select(F.col("low").alias("high"), F.col("root").alias("low")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of a key, and the key, go to the least of them."""
    least = links.groupBy("high").agg(F.min("low").alias("root"))
    return (links.join(least, "high").where("low != root")
            .select(F.col("low").alias("high"), F.col("root").alias("low"))
            .unionByName(least.select("high", F.col("root").alias("low"))).distinct())


def roots(links: DataFrame) -> DataFrame:
    """(key, root) of every key that has a link and isn't the least of its component.

    `links` has two bigint columns `a` and `b`; order, repeats and loops don't matter, rows with
    a null are none.
    """
    spark = links.sparkSession
    links, path = stored_at(_flattened(links.where("a != b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()), "links")
    while not _all_stars(links):
        wired, new_path = stored_at(_small_star(_large_star(links)), "links")
        # A round's links are read by the next one alone.
        remove(spark, path)
        links, path = wired, new_path
    return links.select(F.col("high").alias("key"), F.col("low").alias("root"))
