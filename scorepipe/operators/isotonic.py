"""Isotonic calibration: the monotone step function of a score that is closest to the outcomes.

Pool adjacent violators over distinct scores. Scores are dealt by ranges and each range is pooled in one pass
over its sorted scores; pooling the blocks of two neighbouring ranges gives what pooling their scores together
would. So only ranges whose border violates the order are pooled again, in pairs, until no border does: a task
never holds more than two ranges, and what reaches the driver is two means per range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted
from scorepipe.operators.ordered import range_bounds, with_range_bucket
from scorepipe.sources.tables import settled


def pooled(n: Sequence[float], total: Sequence[float]) -> list[tuple[int, int]]:
    """[start, end) of each block whose mean rises strictly from block to block; n and total are exact sums."""
    starts: list[int] = []
    counts: list = []
    sums: list = []
    for i, (k, s) in enumerate(zip(n, total)):
        start = i
        while counts and sums[-1] * k >= s * counts[-1]:  # the mean before is not smaller
            start, k, s = starts.pop(), k + counts.pop(), s + sums.pop()
        starts.append(start)
        counts.append(k)
        sums.append(s)
    return list(zip(starts, [*starts[1:], len(n)]))


_BLOCKS = "range INT, lo DOUBLE, hi DOUBLE, n BIGINT, pos BIGINT"


def _pool(table: pa.Table) -> pa.Table:
    """Blocks of the rows of one or two ranges; a block belongs to the range in which it begins."""
    table = table.sort_by("lo")
    n, pos = table.column("n").to_pylist(), table.column("pos").to_pylist()
    ranges, lo, hi = (table.column(c).to_pylist() for c in ("range", "lo", "hi"))
    spans = pooled(n, pos)
    columns = [[ranges[a] for a, _ in spans], [lo[a] for a, _ in spans], [hi[b - 1] for _, b in spans], [sum(n[a:b]) for a, b in spans], [sum(pos[a:b]) for a, b in spans]]
    return pa.table({c: pa.array(v, t) for c, v, t in zip(("range", "lo", "hi", "n", "pos"), columns, (pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64()))})


def isotonic_blocks(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """(lo, hi, n, pos, value): the fitted steps; value is the share of positives among the rows with scores in [lo, hi].

    Rows without a score or a label are left out. Labels are 0 and 1.
    """
    s, y = quoted(score).cast("double"), quoted(label)
    rows = df.filter(s.isNotNull() & ~F.isnan(s) & y.isNotNull()).select(s.alias("lo"), (y == 1).cast("bigint").alias("y"))
    bounds = range_bounds(rows, "lo", buckets)
    scores = rows.groupBy("lo").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos"))
    scores = with_range_bucket(scores, "lo", bounds, "b").select(F.col("b").cast("int").alias("range"), "lo", F.col("lo").alias("hi"), "n", "pos")
    now = settled(scores.groupBy("range").applyInArrow(_pool, _BLOCKS))
    mean = F.col("pos") / F.col("n")
    parity = 0
    while True:
        # two means of each range that holds a block
        ends = now.groupBy("range").agg(F.min(mean).alias("first"), F.max(mean).alias("last")).orderBy("range").collect()
        wrong = [a["last"] >= b["first"] for a, b in zip(ends, ends[1:])]
        if not any(wrong):
            break
        pairs = [i for i in range(parity, len(wrong), 2) if wrong[i]]
        parity = 1 - parity
        if not pairs:
            continue
        partner = {ends[i + 1]["range"]: ends[i]["range"] for i in pairs}
        touched = {*partner, *partner.values()}
        spark = df.sparkSession
        groups = spark.createDataFrame([(r, partner.get(r, r), r in touched) for r in (e["range"] for e in ends)], "range INT, pair INT, again BOOLEAN")
        placed = now.join(F.broadcast(groups), "range")  # one row per range
        again = placed.filter("again").groupBy("pair").applyInArrow(lambda t: _pool(t.select(["range", "lo", "hi", "n", "pos"])), _BLOCKS)
        now = settled(placed.filter("NOT again").select("range", "lo", "hi", "n", "pos").unionByName(again))
    return now.select("lo", "hi", "n", "pos", mean.alias("value"))


def calibrated(df: DataFrame, blocks: DataFrame, score: str, out: str = "calibrated") -> DataFrame:
    """Add the value of the step that a score lies on: the last one that begins at or below it, the first for smaller scores.

    Distinct scores meet the steps in ranges, so a score that many rows share is looked up once; no score, no value.
    """
    x = quoted(score).cast("double")
    scores = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("_at")).distinct()
    bounds = range_bounds(scores, "_at")
    asked = with_range_bucket(scores, "_at", bounds, "_b").select(F.col("_b").cast("int").alias("_b"), "_at", F.lit(None).cast("double").alias("_value"))
    ordered = with_range_bucket(blocks, "lo", bounds, "b").select(F.col("b").cast("int").alias("_b"), F.col("lo").alias("_at"), F.col("value").alias("_value"))
    # the step that a range begins on: the last one of an earlier range, else the first of all
    ends = {r["_b"]: (r["low"], r["top"]) for r in ordered.groupBy("_b").agg(F.min("_value").alias("low"), F.max("_value").alias("top")).collect()}
    value, begins = min((low for low, _ in ends.values()), default=None), []
    for b in range(len(bounds) + 1):
        begins.append((b, -math.inf, value))
        value = ends[b][1] if b in ends else value
    steps = ordered.unionByName(df.sparkSession.createDataFrame(begins, "_b INT, _at DOUBLE, _value DOUBLE"))
    both = asked.withColumn("_asked", F.lit(True)).unionByName(steps.withColumn("_asked", F.lit(False)))
    upto = Window.partitionBy("_b").orderBy("_at", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn(out, F.last("_value", True).over(upto)).filter("_asked").select(F.col("_at").alias("_score"), out)
    return df.join(found, x == F.col("_score"), "left").drop("_score")
