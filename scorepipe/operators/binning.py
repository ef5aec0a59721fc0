"""Fitted bins: cut points taken from one frame, stored, and applied to any other.

A bin table has one row per column with its cut points, the exact quantiles of the fitting frame. Bin b holds
the values above cut b - 1 up to cut b; both ends are open, so no value lies outside, and missing values (NULL
and NaN) have a bin of their own, -1. The table is as large as columns times bins.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted, ratio
from scorepipe.operators.isotonic import pooled
from scorepipe.operators.ordered import order_statistics

MISSING = -1


def fit_bins(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """(column, cuts): up to bins - 1 distinct inner quantiles; none for a column without values."""
    found = order_statistics(df, cols, [i / bins for i in range(1, bins)])
    cuts = found.groupBy("column").agg(F.array_sort(F.collect_set("value")).alias("cuts"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column STRING")
    return names.join(cuts, "column", "left").select("column", F.coalesce("cuts", F.array().cast("array<double>")).alias("cuts"))


def cut_points(table: DataFrame) -> dict[str, list[float]]:
    return {r["column"]: list(r["cuts"]) for r in table.collect()}


def bin_of(value: Column, cuts: list[float]) -> Column:
    """Number of cuts below a value; -1 where it is missing."""
    x = value.cast("double")
    above = F.lit(0)
    for c in cuts:
        above = above + (x > F.lit(float(c))).cast("int")
    return F.when(x.isNull() | F.isnan(x), MISSING).otherwise(above)


def with_bins(df: DataFrame, table: DataFrame, suffix: str = "_bin") -> DataFrame:
    """Add the bin of every column of the table."""
    return df.withColumns({c + suffix: bin_of(quoted(c), cuts) for c, cuts in cut_points(table).items()})


def bin_counts(df: DataFrame, cuts: dict[str, list[float]], sums: dict[str, Column]) -> DataFrame:
    """(column, bin, lo, hi, sums...): sums over the rows of every bin, empty bins included. One pass; rows are not exploded."""
    cells, named = [], []
    for i, (c, points) in enumerate(cuts.items()):
        own = bin_of(quoted(c), points)
        edges = [float("-inf"), *points, float("inf")]
        for b in range(MISSING, len(points) + 1):
            names = {name: f"s{i}_{b + 1}_{name}" for name in sums}
            cells += [F.sum(F.when(own == b, value).otherwise(0)).alias(names[name]) for name, value in sums.items()]
            lo, hi = (None, None) if b == MISSING else (edges[b], edges[b + 1])
            fixed = [F.lit(c).alias("column"), F.lit(b).alias("bin"), F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")]
            named.append(F.struct(*fixed, *[F.coalesce(F.col(names[n]), F.lit(0)).cast("bigint").alias(n) for n in sums]))
    return df.agg(*cells).select(F.inline(F.array(*named)))


def stability_by_bins(expected: DataFrame, actual: DataFrame, table: DataFrame, least: float = 1e-4) -> DataFrame:
    """(column, bin, lo, hi, expected, actual, psi): shares of both frames in the bins that the table's frame was cut into.

    The table is usually fitted on ``expected``. An empty bin counts as a share of ``least``; the index of a column is
    the sum of psi over its bins. Every row lies in a bin, those with a missing value in bin -1.
    """
    cuts = cut_points(table)

    def shares(df, name):
        counted = bin_counts(df, cuts, {"n": F.lit(1)})
        share = ratio(F.col("n"), F.sum("n").over(Window.partitionBy("column")))  # over bins, not rows
        return counted.select("column", "bin", "lo", "hi", F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(float(least))).alias(name))

    both = shares(expected, "expected").join(shares(actual, "actual").drop("lo", "hi"), ["column", "bin"])
    psi = (F.col("actual") - F.col("expected")) * F.log(F.col("actual") / F.col("expected"))
    return both.select("column", "bin", "lo", "hi", "expected", "actual", psi.alias("psi"))


def _weighted(counts: DataFrame, keys: Iterable[str]) -> DataFrame:
    whole = Window.partitionBy("column")
    p, n = F.sum("n_pos").over(whole), F.sum("n_neg").over(whole)
    half = F.lit(0.5).cast("double")
    woe = F.log(((F.col("n_pos") + half) / (p + half)) / ((F.col("n_neg") + half) / (n + half)))
    iv = (ratio(F.col("n_pos"), p) - ratio(F.col("n_neg"), n)) * woe
    return counts.select(*keys, "n_pos", "n_neg", woe.alias("woe"), iv.alias("iv"))


def evidence_by_bins(df: DataFrame, label: str, table: DataFrame, monotone: bool = True) -> DataFrame:
    """(column, part, lo, hi, n_pos, n_neg, woe, iv): weight of evidence of the bins of numeric columns.

    With ``monotone`` neighbouring bins are merged until the event rate only rises, or only falls, along a column:
    pool adjacent violators in both directions, and the one with the larger information value stays (rising on a
    tie). Empty bins are dropped first. Missing values, where there are some, are part -1 and never merged. Half a
    row is added so that no part is infinite. Rows without a label are left out.
    """
    y = quoted(label)
    known = df.filter(y.isNotNull())
    counts = bin_counts(known, cut_points(table), {"n_pos": (y == 1).cast("int"), "n_neg": (y != 1).cast("int")}).filter("n_pos + n_neg > 0")
    keys = ["column", "part", "lo", "hi"]
    if not monotone:
        return _weighted(counts.withColumnRenamed("bin", "part"), keys)

    def merge(part: pa.Table) -> pa.Table:
        part = part.sort_by("bin")  # the bins of one column
        rows = [r for r in part.to_pylist() if r["bin"] >= 0]
        out = {k: [] for k in ("column", "rising", "part", "lo", "hi", "n_pos", "n_neg")}
        for rising in (True, False):
            own = rows if rising else rows[::-1]
            blocks = pooled([r["n_pos"] + r["n_neg"] for r in own], [r["n_pos"] for r in own])
            spans = [own[a:b] for a, b in blocks]
            for i, span in enumerate(spans if rising else spans[::-1]):
                cells = (span[0]["column"], rising, i, min(r["lo"] for r in span), max(r["hi"] for r in span), sum(r["n_pos"] for r in span), sum(r["n_neg"] for r in span))
                for values, cell in zip(out.values(), cells):
                    values.append(cell)
            for r in part.to_pylist():
                if r["bin"] < 0:
                    for values, cell in zip(out.values(), (r["column"], rising, MISSING, None, None, r["n_pos"], r["n_neg"])):
                        values.append(cell)
        kinds = (pa.string(), pa.bool_(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    schema = "column STRING, rising BOOLEAN, part INT, lo DOUBLE, hi DOUBLE, n_pos BIGINT, n_neg BIGINT"
    both = counts.groupBy("column").applyInArrow(merge, schema)
    ways = [_weighted(both.filter(F.col("rising") == way), keys).withColumn("rising", F.lit(way)) for way in (True, False)]
    every = ways[0].unionByName(ways[1])
    value = every.groupBy("column", "rising").agg(F.round(F.sum("iv"), 12).alias("value"))
    best = value.groupBy("column").agg(F.max(F.struct("value", "rising")).alias("best")).select("column", F.col("best.rising").alias("rising"))
    return every.join(best, ["column", "rising"]).drop("rising")


def information_values(evidence: DataFrame) -> DataFrame:
    """(column, parts, iv): the information value of each column."""
    return evidence.groupBy("column").agg(F.count(F.lit(1)).alias("parts"), F.sum("iv").alias("iv"))
