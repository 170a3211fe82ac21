"""Links within groups of any size, as few as connect what is alike.

A group's members belong to components already, at first each to its own. Only links between different
components are of interest, and a spanning forest of those. A group that outgrows a task is dealt out
twice:

1. Over parts by hash, the same one member (the pivot) being in all of them. Of a tight group nearly
   everything is joined by that.
2. What isn't in the group's largest component by then meets, part by part, all that is in another
   component. Members of the largest component don't meet each other.

So any two members that aren't in one component meet in a task. Rows dealt out are about twice the
members, as long as what is left over fits a part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import arrow_map, stored, whole_groups
from tillstream.llm.graph import roots

# From the arrays of a table and the bounds of its groups, pairs of roots that are alike.
Compare = Callable[[pa.Table, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of these links between numbers, as many as connect the same numbers."""
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)]), axis=1)
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    kept = []
    for k, (a, b) in enumerate(pairs.T.tolist()):
        a, b = find(a), find(b)
        if a != b:
            parent[b] = a
            kept.append(k)
    return pairs[0, kept], pairs[1, kept]


def spread(members: int, near: Callable[[int, np.ndarray], np.ndarray],
           root: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Grows trees over the members of a group: (place of a member, places it is the first to reach).
    Members of one component reach each other; `near(member, places)` tells what else does."""
    rest = np.arange(members)
    while len(rest) > 1:
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            member = front.pop()
            same = root[rest] == root[member]
            close = near(member, rest) & ~same
            if close.any():
                yield member, rest[close]
            joined = close | same
            front += rest[joined].tolist()
            rest = rest[~joined]


def _compared(dealt: DataFrame, task: list[str], compare: Compare, rows: int) -> DataFrame:
    """Links (a, b) of roots from the tasks."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, task, rows):
            links = compare(table, starts)
            if links:
                a, b = forest(*(np.concatenate(side) for side in zip(*links, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    sorted_tasks = dealt.repartition(*task).sortWithinPartitions(*task)
    return arrow_map(sorted_tasks, found, "a bigint, b bigint")


def _part(parts: Column | str) -> Column:
    """Members are dealt by a hash of their own, not by the one that deals rows to partitions."""
    return F.pmod(F.xxhash64("member", F.lit("part")), F.col(parts) if isinstance(parts, str) else parts
                  ).cast("int")


def _everything(rows: DataFrame, large: DataFrame, keys: list[str]) -> DataFrame:
    """Step 1: each member in its part, the pivot in all."""
    parts = F.coalesce("parts", F.lit(1))
    every = F.sequence(F.lit(0), parts - 1)
    return (rows.join(large.select(*keys, "parts", "pivot"), keys, "left")
            .withColumn("first_part", F.explode(F.when(
                F.col("member") == F.col("pivot"), every).otherwise(F.array(_part(parts)))))
            .withColumn("second_part", F.lit(-1)).drop("parts", "pivot"))


def leftovers(rows: DataFrame, large: DataFrame, keys: list[str], part: int) -> DataFrame:
    """Step 2: members of the large groups, so that those of different components meet."""
    of_large = rows.join(large.select(*keys), keys, "left_semi")
    sizes = of_large.groupBy(*keys, "root").count()
    main = sizes.groupBy(*keys).agg(
        F.max(F.struct("count", "root")).alias("main"), F.sum("count").alias("total"))
    main = main.select(
        *keys, F.col("main.root").alias("main"),
        F.ceil(F.col("main.count") / part).cast("int").alias("main_parts"),
        F.ceil((F.col("total") - F.col("main.count")) / part).cast("int").alias("left_parts"))
    main = stored(main.where("left_parts > 0"), "leftovers")
    own, other = _part("main_parts"), _part("left_parts")
    lefts, mains = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("left_parts", "main_parts"))

    def tasks(of: Column, task: Callable[[Column], tuple[Column, Column]]) -> Column:
        return F.transform(of, lambda x: F.struct(
            task(x)[0].alias("first_part"), task(x)[1].alias("second_part")))

    # Tasks of a part of the main component have that as a negative number.
    in_main = tasks(lefts, lambda x: (x, -2 - own))
    left_over = F.concat(tasks(mains, lambda x: (other, -2 - x)), tasks(
        lefts, lambda x: (F.least(x, other), F.greatest(x, other))))
    dealt = of_large.join(main, keys).withColumn("task", F.explode(
        F.when(F.col("root") == F.col("main"), in_main).otherwise(left_over)))
    return dealt.select(*rows.columns, "task.*")


def linked(rows: DataFrame, keys: list[str], compare: Compare, part: int,
           batch_rows: int = 1 << 18) -> DataFrame:
    """(root, joined): the roots that get another one by what is alike within groups.

    `rows` has the keys (whole numbers), bigint `member` and `root`, and what `compare` needs.
    """
    task = [*keys, "first_part", "second_part"]
    large = stored(
        rows.groupBy(*keys).agg(F.count("*").alias("members"), F.min("member").alias("pivot"),
                                F.min("root").alias("low"), F.max("root").alias("high"))
        .where((F.col("members") > part) & (F.col("low") != F.col("high")))
        .select(*keys, "pivot", F.ceil(F.col("members") / part).cast("int").alias("parts")),
        "large-groups")
    links = _compared(_everything(rows, large, keys), task, compare, batch_rows)
    found = roots(links).select(F.col("key").alias("root"), F.col("root").alias("joined"))
    if large.isEmpty():
        return found
    rest = leftovers(contracted(rows, found), large, keys, part)
    more = _compared(rest, task, compare, batch_rows)
    both = found.select(F.col("root").alias("a"), F.col("joined").alias("b")).unionByName(more)
    return roots(both).select(F.col("key").alias("root"), F.col("root").alias("joined"))


def contracted(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with their roots replaced by those they were joined to."""
    return rows.join(joined, "root", "left").withColumn(
        "root", F.coalesce("joined", "root")).select(*rows.columns)
