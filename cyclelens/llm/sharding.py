"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Rows with equal texts form a group that is never divided. A group of more than one part
in `BUNDLES` of all bytes is an item of its own (there are fewer than `BUNDLES` of them);
the others are bundled by a hash into at most `BUNDLES` items, by partial sums before the
shuffle. Differencing therefore sees at most 2 x `BUNDLES` items however large the table
is: the two partial partitions with the largest spread are combined, one in descending
and one in ascending order, until one is left. The list of large groups and the map from
bundles to shards are bounded in the same way, so they may be broadcast; rows are never
shuffled to find their shard.

Size of a row: the UTF-8 bytes of its text (null: none) plus 1. All null texts are one
group. Repeated rows stay together, being equal texts, and get slots of their own. A
group larger than a fair shard makes its shard as large as itself; no other does. An
empty table gives an empty result. Only the named columns are read, so further columns of
any name do no harm.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclelens.session import written

BUNDLES = 8192
ROWS_PER_CELL = 1024


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item: Karmarkar-Karp differencing into `shards` parts."""
    heap = []
    for i, size in enumerate(sizes):
        parts = [(size, i)] + [(0, None)] * (shards - 1)
        heap.append((-size, i, parts))
    heapq.heapify(heap)
    next_id = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        joined = sorted(
            ((a + b, (x, y) if x is not None and y is not None else x if y is None else y)
             for (a, x), (b, y) in zip(one, reversed(other))),
            key=lambda part: -part[0],
        )
        heapq.heappush(heap, (joined[-1][0] - joined[0][0], next_id, joined))
        next_id += 1
    shard_of = [0] * len(sizes)
    for shard, (_, tree) in enumerate(heap[0][2] if heap else []):
        open_nodes = [tree]
        while open_nodes:
            node = open_nodes.pop()
            if isinstance(node, tuple):
                open_nodes += node
            elif node is not None:
                shard_of[node] = shard
    return shard_of


def _differencer(shards: int):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = pd.concat([pd.DataFrame({"item": [], "bytes": []}), *batches])
        items = items.sort_values(["bytes", "item"], ascending=[False, True])
        if len(items):
            yield pd.DataFrame({"item": items["item"], "shard": difference([int(b) for b in items["bytes"]], shards)})

    return assign


def gapless(rows: DataFrame, group: str, order: str, spread: list[str], n_rows: int, groups: int) -> DataFrame:
    """`slot`, numbering the rows of each group from 0 without gaps. The rows of a group
    are dealt into cells by a hash of `spread`; a cell is numbered by itself, behind all
    rows of the cells before it."""
    cells = max(1, -(-n_rows // (ROWS_PER_CELL * groups)))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(*spread), F.lit(cells)))
    counts = rows.groupBy(group, "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy(group, "cell").orderBy(order, *spread)) - 1
    numbered = rows.withColumn("inside", inside).join(offsets, [group, "cell"])
    return numbered.withColumn("slot", (F.col("inside") + F.col("offset")).cast("long")).drop("inside", "offset", "cell")


def by_bytes(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
             bundles: int = BUNDLES) -> DataFrame:
    """`row_id`, `size`, `text_crc32`, `shard` and `slot` for every row."""
    text = F.col(text_col).cast("string")
    rows = written(df.select(
        F.col(id_col).alias("row_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.coalesce(F.md5(text), F.lit("null")).alias("group"),
    ), "shard-rows")
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    is_large = F.col("bytes") * bundles > total["bytes"]
    bundle = F.concat(F.lit("bundle-"), F.pmod(F.xxhash64("group"), F.lit(bundles)).cast("string"))
    items = groups.groupBy(F.when(is_large, F.col("group")).otherwise(bundle).alias("item")).agg(F.sum("bytes").alias("bytes"))
    shard_of = written(items.repartition(1).mapInPandas(_differencer(shards), "item string, shard int"), "shard-items")
    # Both maps hold fewer than `bundles` rows each.
    large = shard_of.where(~F.col("item").startswith("bundle-"))
    small = shard_of.where(F.col("item").startswith("bundle-"))
    placed = (
        rows.join(F.broadcast(large.toDF("group", "own_shard")), "group", "left")
        .withColumn("item", bundle)
        .join(F.broadcast(small.withColumnRenamed("shard", "bundle_shard")), "item", "left")
        .withColumn("shard", F.coalesce("own_shard", "bundle_shard"))
        .select("row_id", "size", "text_crc32", "shard")
    )
    return gapless(placed, "shard", "row_id", ["row_id", "text_crc32", "size"], total["n"], shards)
