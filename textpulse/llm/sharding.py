"""Resharding by minimum-cost flow.

Old shards supply bytes, new shards demand them, and a byte that stays in its shard costs
nothing. The cheapest flow between the (few) shards says how many bytes go from where to
where; each old shard, in a fixed order of blocks and rows, is then cut at those amounts.
Only shard totals reach the driver; rows are placed by block prefix sums.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textpulse.llm.common import broadcast_if_small, row_key, store

#: Average rows of a block, the unit that is sorted in one task and rewritten as one folder.
BLOCK_ROWS = 50_000

#: Blocks of an old shard at least, so that even small shards are sorted by several tasks.
LEAST_BLOCKS = 16


def cheapest_flow(
    supply: Sequence[int], demand: Sequence[int], cost: Sequence[Sequence[int]]
) -> list[list[int]]:
    """Amounts [from][to] that ship all supply within demand at the least cost.

    Successive shortest paths with potentials on the bipartite graph. Needs
    sum(demand) >= sum(supply); amounts are integers.
    """
    n, m = len(supply), len(demand)
    if sum(demand) < sum(supply):
        raise ValueError("the new shards cannot hold the old ones")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(demand)
    potential = [0] * (n + m)
    while any(left):
        distance = [float("inf")] * (n + m)
        parent = [-1] * (n + m)
        heap = [(0, i) for i in range(n) if left[i]]
        for _, i in heap:
            distance[i] = 0
        heapq.heapify(heap)
        while heap:
            far, u = heapq.heappop(heap)
            if far > distance[u]:
                continue
            if u < n:
                steps = [(n + j, cost[u][j]) for j in range(m)]
            else:
                steps = [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, price in steps:
                reach = far + price + potential[u] - potential[v]
                if reach < distance[v]:
                    distance[v], parent[v] = reach, u
                    heapq.heappush(heap, (reach, v))
        end = min((n + j for j in range(m) if room[j]), key=lambda v: distance[v] + potential[v])
        for v in range(n + m):
            potential[v] += min(distance[v], distance[end])
        path, v = [], end
        while parent[v] >= 0:
            path.append((parent[v], v))
            v = parent[v]
        amount = min(left[v], room[end - n], *(flow[b][a - n] for a, b in path if a >= n))
        left[v] -= amount
        room[end - n] -= amount
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
    return flow


def near_equal(total: int, shards: int) -> list[int]:
    """Capacities that add up to ``total`` and differ by one byte at most."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def transfers(totals: dict[int, int], capacities: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(old shard, new shard, first byte, end byte) of the cheapest moves, gapless per old shard."""
    old = sorted(totals)
    cost = [[int(i != j) for j in range(len(capacities))] for i in old]
    flow = cheapest_flow([totals[i] for i in old], capacities, cost)
    cuts = []
    for i, row in zip(old, flow):
        at = 0
        for j in sorted(range(len(row)), key=lambda j: (j != i, j)):
            if row[j]:
                cuts.append((i, j, at, at + row[j]))
                at += row[j]
    return cuts


def place(
    docs: DataFrame,
    old_shard: Column,
    shards: int,
    capacities: Sequence[int] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: key, size, text_crc32, old_shard, block, shard, slot.

    Size is the UTF-8 bytes of the text (null: none) plus 1. ``old_shard`` is an integer
    expression, not null, with few values. ``capacities`` default to near-equal bytes; a
    document goes where its middle falls, so a shard misses its capacity by at most half a
    document on each of its cuts. Slots count from 0 without gaps. Repeated rows take
    slots of their own; null keys come last in a block; an empty table gives no rows.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        old_shard.cast("int").alias("old_shard"),
        row_key(key, text).alias("_row"),
    )
    sized = store(sized, "sizes")
    sums = sized.groupBy("old_shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    totals = {r["old_shard"]: r["b"] for r in sums}
    capacities = capacities or near_equal(sum(totals.values()), shards)
    cuts = spark.createDataFrame(
        transfers(totals, capacities), "old_shard int, shard int, first long, past long"
    )
    most = max([r["n"] for r in sums], default=0)
    blocks = max(LEAST_BLOCKS, -(-most // BLOCK_ROWS))
    sized = sized.withColumn("block", F.pmod("_row", F.lit(blocks)).cast("int"))
    by_block = Window.partitionBy("old_shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sized.groupBy("old_shard", "block")
        .agg(F.sum("size").alias("_bytes"))
        .withColumn("_before", F.coalesce(F.sum("_bytes").over(by_block), F.lit(0)))
        .drop("_bytes")
    )
    order = [F.col(key).asc_nulls_last(), F.col("_row")]
    within = Window.partitionBy("old_shard", "block").orderBy(*order)
    earlier = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    # At most (old shards x new shards) rows.
    placed = (
        sized.withColumn("_inside", F.coalesce(earlier, F.lit(0)))
        .join(offsets, ["old_shard", "block"])
        .withColumn("_middle", 2 * (F.col("_before") + F.col("_inside")) + F.col("size"))
        .join(F.broadcast(cuts), "old_shard")
        .filter((F.col("_middle") >= 2 * F.col("first")) & (F.col("_middle") < 2 * F.col("past")))
    )
    rank = F.row_number().over(Window.partitionBy("old_shard", "block", "shard").orderBy(*order))
    placed = store(
        placed.select(key, "size", "text_crc32", "old_shard", "block", "shard", (rank - 1).alias("_rank"), "_row"),
        "placed",
    )
    up_to = Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        placed.groupBy("shard", "old_shard", "block")
        .agg(F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(up_to), F.lit(0)))
        .drop("_n")
    )
    firsts = broadcast_if_small(store(firsts, "firsts"), 32)
    return placed.join(firsts, ["shard", "old_shard", "block"]).select(
        key, "size", "text_crc32", "old_shard", "block", "shard",
        (F.col("_first") + F.col("_rank")).cast("long").alias("slot"), F.col("_row").alias("row_key"),
    )


def write_blocks(
    docs: DataFrame, placed: DataFrame, folder: str, key: str = "doc_id", text: str = "text", old_shard: Column | None = None
) -> None:
    """The old layout as files: ``old_shard=I/block=B`` below ``folder``, each row once.

    ``old_shard`` is what ``place`` was given. It may be left out only if rows that are equal
    in key and text share their old shard; else it is an error.
    """
    where = placed.select("row_key", "old_shard", "block").dropDuplicates(["row_key", "old_shard"])
    keyed = docs.withColumn("row_key", row_key(key, text))
    if old_shard is not None:
        keyed = keyed.withColumn("old_shard", old_shard.cast("int"))
    elif not where.groupBy("row_key").count().filter("count > 1").isEmpty():
        raise ValueError("equal rows lie in several old shards: give old_shard")
    keyed.join(where, ["row_key"] if old_shard is None else ["row_key", "old_shard"]).write.partitionBy("old_shard", "block").parquet(folder)


def rewrite_affected(spark: SparkSession, placed: DataFrame, old: str, new: str) -> DataFrame:
    """Write the rows of affected blocks to ``new``; return where each shard's rows now lie.

    A block is affected when any of its rows changes shard. Blocks that keep their rows stay
    in ``old`` as they are. Returns (shard, folder, rows); read a shard from all its folders.
    """
    moved = F.max((F.col("shard") != F.col("old_shard")).cast("int"))
    touched = placed.groupBy("old_shard", "block").agg(moved.alias("_moved"))
    state = placed.join(touched, ["old_shard", "block"])
    rows = spark.read.parquet(old)
    # The k-th of several equal rows goes where the k-th placement says.
    turn = Window.partitionBy("old_shard", "block", "row_key")
    targets = (
        state.filter("_moved = 1")
        .withColumn("_turn", F.row_number().over(turn.orderBy("shard", "slot")))
        .select("old_shard", "block", "row_key", "_turn", "shard", "slot")
    )
    affected = rows.join(
        touched.filter("_moved = 1").select("old_shard", "block"), ["old_shard", "block"], "left_semi"
    ).withColumn("_turn", F.row_number().over(turn.orderBy("row_key")))
    (
        affected.join(targets, ["old_shard", "block", "row_key", "_turn"])
        .drop("_turn", "old_shard", "row_key")
        .write.partitionBy("shard", "block")
        .parquet(new)
    )
    folder = F.when(F.col("_moved") == 1, F.concat_ws("/", F.lit(new), F.concat(F.lit("shard="), "shard"),
                                                     F.concat(F.lit("block="), "block"))).otherwise(
        F.concat_ws("/", F.lit(old), F.concat(F.lit("old_shard="), "old_shard"), F.concat(F.lit("block="), "block"))
    )
    return state.groupBy("shard", folder.alias("folder")).agg(F.count("*").alias("rows"))
