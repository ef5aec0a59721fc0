"""Resharding that moves the fewest bytes, as a minimum-cost flow from old shards to new capacities.

An old shard's rows are cut into blocks by size (four to an octave). The flow network has a source arc to each
block with its row count, a free arc from a block to the shard of the same number, an arc to an exchange at the
block's mean bytes a row, free arcs from the exchange to every new shard, and arcs from new shards to the sink
with their capacities: the whole quotient of rows and shards, plus one more for as many shards as the remainder
says. It is solved on the driver; its size depends on the shard counts only, not on the rows.

Rows then learn their place. A row's position in its old shard follows (block, slice, rank in the slice), where
slices are hash parts of a block of bounded size, so no shard is ranked in one task. The flow turns positions
into a few intervals a shard; an interval says the new shard and the first slot. Affected shards are rewritten
as Parquet, one folder a shard; shards that neither lose nor gain rows are left alone.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.session import work_path

SHARDS = 40
OVERHEAD = 16
SLICE_ROWS = 20_000


class Network:
    """Successive shortest paths with potentials; all costs are at least zero."""

    def __init__(self):
        self.arcs: list[list] = []  # [to, capacity left, cost]; arc i and i ^ 1 are each other's reverse
        self.out: dict[object, list[int]] = {}

    def arc(self, a, b, capacity: int, cost: float) -> int:
        self.arcs += [[b, capacity, cost], [a, 0, -cost]]
        self.out.setdefault(a, []).append(len(self.arcs) - 2)
        self.out.setdefault(b, []).append(len(self.arcs) - 1)
        return len(self.arcs) - 2

    def flow(self, i: int) -> int:
        return self.arcs[i ^ 1][1]

    def send(self, source, sink) -> int:
        """Push all the flow there is, cheapest paths first."""
        height = dict.fromkeys(self.out, 0.0)
        sent = 0
        while True:
            far, through, done, heap, tie = {source: 0.0}, {}, set(), [(0.0, 0, source)], 0
            while heap:
                d, _, a = heapq.heappop(heap)
                if a in done:
                    continue
                done.add(a)
                for i in self.out[a]:
                    b, left, cost = self.arcs[i]
                    to = d + max(0.0, cost + height[a] - height[b])
                    if left > 0 and to < far.get(b, float("inf")):
                        far[b], through[b], tie = to, i, tie + 1
                        heapq.heappush(heap, (to, tie, b))
            if sink not in far:
                return sent
            for a in self.out:
                height[a] += min(far.get(a, far[sink]), far[sink])
            path, a = [], sink
            while a != source:
                path.append(through[a])
                a = self.arcs[through[a] ^ 1][0]
            amount = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= amount
                self.arcs[i ^ 1][1] += amount
            sent += amount


@dataclass
class Plan:
    """moved[(old, block)]: rows that leave; taken[new]: rows that come in."""

    moved: dict[tuple[int, int], int]
    taken: list[int]


def solve(blocks: dict[tuple[int, int], tuple[int, int]], shards: int) -> Plan:
    """blocks: (old shard, block) -> (rows, bytes). Old shards beyond the new count lose all their rows."""
    total = sum(n for n, _ in blocks.values())
    base, more = divmod(total, shards)
    net = Network()
    leave, enter = {}, []
    for key, (rows, size) in sorted(blocks.items()):
        net.arc("source", ("block", *key), rows, 0)
        if key[0] < shards:
            net.arc(("block", *key), ("new", key[0]), rows, 0)
        leave[key] = net.arc(("block", *key), "exchange", rows, size / rows)
    for j in range(shards):
        enter.append(net.arc("exchange", ("new", j), base + 1, 0))
        net.arc(("new", j), "sink", base, 0)
        net.arc(("new", j), "remainder", 1, 0)
    net.arc("remainder", "sink", more, 0)
    if blocks and net.send("source", "sink") != total:
        raise RuntimeError("the flow does not place every row")
    return Plan({k: net.flow(i) for k, i in leave.items()}, [net.flow(i) for i in enter])


def intervals(blocks: dict[tuple[int, int], tuple[int, int]], plan: Plan, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(old shard, first position, end, new shard, first slot), positions counted in the old shard by block.

    A shard's own rows keep the order they have and come first; rows that come in follow.
    """
    out, room, filled = [], list(plan.taken), [0] * shards
    movers = []
    at: dict[int, int] = {}
    for (old, block), (rows, _) in sorted(blocks.items()):
        start, moved = at.get(old, 0), plan.moved[old, block]
        at[old] = start + rows
        if moved:
            movers.append((old, start, start + moved))
        if moved < rows:
            out.append((old, start + moved, start + rows, old, filled[old]))
            filled[old] += rows - moved
    j = 0
    for old, start, end in movers:
        while start < end:
            while not room[j]:
                j += 1
            n = min(room[j], end - start)
            out.append((old, start, start + n, j, filled[j]))
            filled[j] += n
            room[j] -= n
            start += n
    return sorted(out)


def measured(docs: DataFrame, old_shard: Column) -> DataFrame:
    """The rows with size, checksum, old shard and block; a null text counts as empty, a null old shard as 0."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    size = F.octet_length(raw).cast("bigint") + OVERHEAD
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), size.alias("size"), F.crc32(raw).alias("text_crc32"),
        F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old"), F.floor(4 * F.log2(size.cast("double"))).cast("int").alias("block"),
    )


def reshard(docs: DataFrame, old_shard: Column, shards: int = SHARDS, slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, str]:
    """(assignment, folder of the rewritten shards).

    assignment: (doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row, law ``rows``: counts are at
    most one apart. ``old_shard`` is a column of ``docs`` whose numbers are at least 0 and of bounded count. Null
    texts count 16 bytes, null ids and repeated rows get a place each (equal rows are interchangeable), extra
    columns are ignored, an empty table gives no rows. grown_shard is null under this law.
    """
    spark = docs.sparkSession
    rows = measured(docs, old_shard)
    counted = rows.groupBy("old", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).collect()
    blocks = {(r["old"], r["block"]): (r["n"], r["bytes"]) for r in counted}
    if any(old < 0 for old, _ in blocks):
        raise ValueError("old shard numbers must be at least 0")
    plan = solve(blocks, shards)
    spans = intervals(blocks, plan, shards)
    lost = {old for (old, _), n in plan.moved.items() if n}
    affected = sorted({old for old in lost if old < shards} | {j for j, n in enumerate(plan.taken) if n})

    slices = max(1, -(-sum(n for n, _ in blocks.values()) // slice_rows))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slices)).cast("int"))
    place = ["old", "block", "slice"]
    before = Window.partitionBy("old").orderBy("block", "slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy(*place).orderBy(F.xxhash64("doc_id", "text_crc32"), "doc_id", "text_crc32", "size")
    # one short list of intervals a shard, bounded by the shard counts and 64 blocks each
    kind = "ARRAY<STRUCT<low: BIGINT, high: BIGINT, shard: INT, slot: BIGINT>>"
    by_old: dict[int, list] = {}
    for old, low, high, shard, slot in spans:
        by_old.setdefault(old, []).append((low, high, shard, slot))
    lists = spark.createDataFrame(list(by_old.items()), f"old INT, spans {kind}")
    ranked = sliced.withColumn("rank", F.row_number().over(inside) - 1)
    placed = (
        ranked.join(offsets, place)
        .withColumn("position", F.col("offset") + F.col("rank"))
        .join(F.broadcast(lists), "old")
        .withColumn("span", F.filter("spans", lambda s: (s["low"] <= F.col("position")) & (F.col("position") < s["high"]))[0])
        .select("doc_id", "text", "size", "text_crc32", F.col("span.shard").alias("shard"), (F.col("span.slot") + F.col("position") - F.col("span.low")).alias("slot"))
    )
    folder = work_path(spark, "shards")
    kept = [j for j in range(shards) if j not in set(affected)]
    rewritten = placed.filter(F.col("shard").isin(affected)) if affected else placed.limit(0)
    rewritten.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    stored = spark.read.schema("doc_id BIGINT, text STRING, size BIGINT, text_crc32 BIGINT, slot BIGINT, shard INT").parquet(folder).select(*columns)
    if kept and any(old in kept for old, _ in blocks):
        stored = stored.union(placed.filter(F.col("shard").isin(kept)).select(*columns))
    named = stored.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})
    return named.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"), folder
