"""Frequency tables, profiles and data-quality reports."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorepipe.functions.columns import long_form, numeric_columns, quoted, ratio
from scorepipe.operators.ordered import order_statistics


def value_counts(df: DataFrame, col: str, by: str = "value") -> DataFrame:
    """(value, n), ordered by value or by falling count."""
    counts = df.groupBy(quoted(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if by == "value":
        return counts.orderBy("value")
    if by == "count":
        return counts.orderBy(F.desc("n"), "value")
    raise ValueError("by is 'value' or 'count'")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(quoted(col).alias("value")).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _null_sums(df: DataFrame, cols: list[str]):
    types = {f.name: f.dataType for f in df.schema.fields}
    zero = F.lit(0).cast("bigint")
    out = []
    for i, c in enumerate(cols):
        x = quoted(c)
        nan = F.sum(F.isnan(x).cast("int")) if isinstance(types[c], (T.FloatType, T.DoubleType)) else zero
        out.append(F.coalesce(F.sum(x.isNull().cast("int")), zero).alias(f"null{i}"))
        out.append(F.coalesce(nan, zero).alias(f"nan{i}"))
    return out


def null_profile(df: DataFrame, only_found: bool = False) -> DataFrame:
    """(column, null_count, nan_count) of every column from one aggregation pass.

    NaN is not NULL and is counted apart. `only_found` keeps the columns that have NULLs.
    """
    cols = df.columns
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"null{i}").alias("null_count"), F.col(f"nan{i}").alias("nan_count"))
        for i, c in enumerate(cols)
    ]
    out = df.agg(*_null_sums(df, cols)).select(F.inline(F.array(*rows)))
    return out.filter(F.col("null_count") > 0) if only_found else out


def count_parity(before: DataFrame, after: DataFrame) -> DataFrame:
    """(before_count, after_count, lost, passed): did a layer lose rows?"""
    return (
        row_count(after)
        .select(row_count(before).scalar().alias("before_count"), F.col("n").alias("after_count"))
        .withColumn("lost", F.col("before_count") - F.col("after_count"))
        .withColumn("passed", F.col("lost") == 0)
    )


def label_rate(df: DataFrame, label: str, positive: int = 1) -> DataFrame:
    """Share of positive rows; a NULL label counts as not positive."""
    return df.agg(F.avg(F.when(quoted(label) == positive, 1.0).otherwise(0.0).cast("double")).alias("rate"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, n, percentage of all rows), ordered by label."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = row_count(df).scalar()
    return counts.withColumn("percentage", ratio(F.col("n") * 100, total)).orderBy("label")


def schema_delta(before: DataFrame, after: DataFrame, not_before: tuple = (), not_after: tuple = ()) -> DataFrame:
    """(old_features, new_features, added): feature counts of two layers, given non-features left out."""
    old = len([c for c in before.columns if c.lower() not in {x.lower() for x in not_before}])
    new = len([c for c in after.columns if c.lower() not in {x.lower() for x in not_after}])
    return after.sparkSession.createDataFrame(
        [(old, new, new - old)], "old_features INT, new_features INT, added INT"
    )


def cv_summary(scores: DataFrame, score: str = "score", by: list[str] = ()) -> DataFrame:
    """(folds, mean, std_pop, var_samp): the two spreads in use, named apart."""
    s = quoted(score)
    return scores.groupBy(*[quoted(c) for c in by]).agg(
        F.count(s).alias("folds"),
        F.avg(s).alias("mean"),
        F.stddev_pop(s).alias("std_pop"),
        F.var_samp(s).alias("var_samp"),
    )


def dq_report(df: DataFrame, parent: DataFrame, label: str) -> DataFrame:
    """(check, column, value, passed): NULL counts, row parity and positive rate against the parent layer.

    One aggregation over the layer and one over the parent; the wide one-row results are
    then turned into report rows.
    """
    cols = df.columns
    hit = F.avg(F.when(quoted(label) == 1, 1.0).otherwise(0.0).cast("double"))
    own = df.agg(F.count(F.lit(1)).alias("rows"), hit.alias("rate"), *_null_sums(df, cols))
    upper = row_count(parent).scalar()

    def line(check, column, value, passed):
        return F.struct(
            F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"),
            value.cast("double").alias("value"), passed.alias("passed"),
        )

    lines = [line("null_count", c, F.col(f"null{i}"), F.col(f"null{i}") == 0) for i, c in enumerate(cols)]
    lines += [
        line("row_count", None, F.col("rows"), F.col("rows") == F.col("parent_rows")),
        line("parent_row_count", None, F.col("parent_rows"), F.lit(True)),
        line("lost_rows", None, F.col("parent_rows") - F.col("rows"), F.col("rows") == F.col("parent_rows")),
        line("positive_rate", label, F.col("rate"), F.col("rate").between(0, 1)),
    ]
    return own.withColumn("parent_rows", upper).select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """(column, bin, lo, hi, n): equal-width bins over each column's range, empty bins included.

    The last bin is closed. A constant column gets a range of one around its value. The ranges
    are one row per column, which bounds the broadcast; counting is partial within each task.
    """
    cells = long_form(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    lo, hi = F.min("value"), F.max("value")
    ranges = (
        cells.groupBy("column").agg(lo.alias("mn"), hi.alias("mx"))
        .select(
            "column",
            F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("mn"),
            F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("mx"),
        )
        .withColumn("step", (F.col("mx") - F.col("mn")) / bins)
    )
    guess = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("mn")) / (F.col("mx") - F.col("mn")) * bins)).cast("int")
    # the quotient can miss an edge by one rounding step, so the edges themselves decide
    under = (F.col("value") < F.col("mn") + F.col("bin") * F.col("step")).cast("int")
    over = ((F.col("value") >= F.col("mn") + (F.col("bin") + 1) * F.col("step")) & (F.col("bin") < bins - 1)).cast("int")
    counts = (
        cells.join(F.broadcast(ranges), "column")
        .withColumn("bin", guess)
        .select("column", (F.col("bin") - under + over).alias("bin"))
        .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = ranges.select(
        "column", "mn", "mx", "step", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    edge = F.when(F.col("bin") == bins - 1, F.col("mx")).otherwise(F.col("mn") + (F.col("bin") + 1) * F.col("step"))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", (F.col("mn") + F.col("bin") * F.col("step")).alias("lo"), edge.alias("hi"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def corr_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(a, b, r) for every ordered pair: Pearson correlation over the rows where both are present.

    NULL for a constant column. Each task folds its Arrow batches into one square of sums per
    pair; only these squares are shuffled. Values are shifted by the column mean first, which
    leaves r unchanged and keeps the sums well conditioned.
    """
    cols = cols or numeric_columns(df)
    d = len(cols)
    x = df.select(*[quoted(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    shifts = x.agg(*[F.coalesce(F.avg(F.nanvl(c, F.lit(None))), F.lit(0.0)) for c in x.columns]).first()
    centre = np.array([float(v) for v in shifts])

    def partial(batches):
        sums = np.zeros((6, d, d))
        for batch in batches:
            v = batch.to_numpy(dtype=float, na_value=np.nan) - centre
            here = (~np.isnan(v)).astype(float)
            v = np.where(here > 0, v, 0.0)
            sq = v * v
            sums += [here.T @ here, v.T @ here, here.T @ v, sq.T @ here, here.T @ sq, v.T @ v]
        a, b = np.divmod(np.arange(d * d), d)
        yield pd.DataFrame({"i": a, "j": b, **{f"s{k}": sums[k].ravel() for k in range(6)}})

    parts = x.mapInPandas(partial, "i INT, j INT, " + ", ".join(f"s{k} DOUBLE" for k in range(6)))
    total = parts.groupBy("i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)])
    n, sa, sb, saa, sbb, sab = (F.col(f"s{k}") for k in range(6))

    def spread(square, plain):
        # what is left of a constant column is rounding noise, far below its squared size
        left = square - plain * plain / n
        return F.when((n > 1) & (left > 1e-12 * square), left)

    names = F.array(*[F.lit(c) for c in cols])
    r = (sab - sa * sb / n) / F.sqrt(spread(saa, sa) * spread(sbb, sb))
    return total.select(
        F.get(names, F.col("i")).alias("a"),
        F.get(names, F.col("j")).alias("b"),
        F.when(r > 1, 1.0).when(r < -1, -1.0).otherwise(r).alias("r"),
    )


def top_k(df: DataFrame, by: str, k: int, tie: str, group: list[str] | None = None) -> DataFrame:
    """The k rows with the largest measure, ties by key, overall or per group.

    Per group, Spark keeps at most k rows per group in each task before the shuffle
    (window group limit), so one huge group does not travel whole.
    """
    order = [quoted(by).desc_nulls_last(), quoted(tie).asc()]
    if not group:
        return df.orderBy(*order).limit(k)
    w = Window.partitionBy(*[quoted(g) for g in group]).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, stat, value): count, mean, sample std, min, quartiles and max of numeric columns."""
    cols = cols or numeric_columns(df)
    x = df.select(*[F.nanvl(quoted(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)])
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = x.agg(*[f(c).cast("double").alias(f"{c}_{s}") for c in x.columns for s, f in kinds.items()])
    cells = [
        F.struct(F.lit(cols[i]).alias("column"), F.lit(s).alias("stat"), F.col(f"x{i}_{s}").alias("value"))
        for i in range(len(cols))
        for s in kinds
    ]
    moments = wide.select(F.inline(F.array(*cells)))
    quartiles = order_statistics(df, cols, [0.25, 0.5, 0.75])
    names = F.format_string("%d%%", F.round(F.col("prob") * 100).cast("int"))
    return moments.unionByName(quartiles.select("column", names.alias("stat"), "value"))
