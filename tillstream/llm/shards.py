"""Sharding by longest processing time.

Groups of equal texts stay together. Sorted by size, each goes to the shard with the least load, found
through a heap. What goes through the driver is bounded by `LOTS`, not by the input: a group of
at least a `LOTS`-th of all bytes is placed by itself (there are at most `LOTS` of them); all
smaller groups are gathered by hash into `LOTS` lots, which are placed as groups are.

Places within a shard are numbered by pieces. A lot is one piece; a group placed by itself is cut
into pieces of about a `LOTS`-th of all rows, so a group with a third of all rows is numbered by
many tasks.

Null text counts as empty; null and empty texts are one group. Rows that repeat are placed each.
Ties go to the smaller unit number and shard. Empty table: no rows. Other columns are not carried.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import stored, text_of

LOTS = 1 << 15


def longest_first(sizes: list[int], shards: int) -> list[int]:
    """Shard of each unit: units by falling size, each to the least loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = [0] * len(sizes)
    for unit in sorted(range(len(sizes)), key=lambda u: (-sizes[u], u)):
        load, shard = heapq.heappop(heap)
        placed[unit] = shard
        heapq.heappush(heap, (load + sizes[unit], shard))
    return placed


def place(documents: DataFrame, shards: int) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot."""
    rows = stored(documents.select(
        F.col("doc_id").cast("bigint"),
        (F.octet_length(text_of()) + 1).cast("bigint").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.xxhash64(text_of()).alias("group")), "shard-rows")
    groups = stored(rows.groupBy("group").agg(F.sum("size").alias("bytes"),
                                              F.count("*").alias("rows")), "shard-groups")
    total = groups.agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")).first()
    if not total["rows"]:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"),
                           F.lit(0).cast("bigint").alias("slot"))
    piece_rows = -(-total["rows"] // LOTS)

    single = F.col("bytes") * LOTS >= total["bytes"]
    singles = groups.where(single).select(
        "group", F.ceil(F.col("rows") / piece_rows).cast("bigint").alias("pieces"), "bytes").toPandas()
    lot = F.pmod(F.xxhash64("group"), F.lit(LOTS))
    lots = groups.where(~single).groupBy(lot.alias("lot")).agg(F.sum("bytes").alias("bytes")).toPandas()

    singles = singles.sort_values(["bytes", "group"], ascending=[False, True], ignore_index=True)
    lots = lots.sort_values("lot", ignore_index=True)
    shard = longest_first([*map(int, singles["bytes"]), *map(int, lots["bytes"])], shards)

    # At most LOTS rows each.
    spark = documents.sparkSession
    units = [*range(len(singles)), *(-1 - int(x) for x in lots["lot"])]
    of_group = spark.createDataFrame(
        [(int(g), int(p), u) for u, (g, p) in enumerate(
            zip(singles["group"], singles["pieces"], strict=True))],
        "group bigint, pieces bigint, unit bigint")
    placed = (rows.join(F.broadcast(of_group), "group", "left")
              .withColumn("unit", F.coalesce("unit", -1 - lot))
              .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("pieces")),
                                              F.lit(0))))

    # Pieces of a shard one behind the other: at most 3 x LOTS rows.
    pieces = placed.groupBy("unit", "piece").agg(F.count("*").alias("rows")).toPandas()
    pieces["shard"] = pieces["unit"].map(dict(zip(units, shard, strict=True)))
    pieces = pieces.sort_values(["shard", "unit", "piece"], ignore_index=True)
    pieces["first"] = pieces.groupby("shard")["rows"].cumsum() - pieces["rows"]
    starts = spark.createDataFrame(
        pd.DataFrame(pieces[["unit", "piece", "shard", "first"]]).astype("int64"),
        "unit bigint, piece bigint, shard bigint, first bigint")
    within = Window.partitionBy("unit", "piece").orderBy("doc_id", "text_crc32")
    return (placed.join(F.broadcast(starts), ["unit", "piece"])
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.row_number().over(within) - 1).alias("slot")))
