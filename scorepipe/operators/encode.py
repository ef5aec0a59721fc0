"""Fitted encodings: category levels and column scaling.

`fit_*` returns a small table (one row per level or per column) that can be stored; the transform
is a pure projection with those values as literals, so its schema never depends on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.functions.columns import long_form, quoted

MAX_LEVELS = 1000


def fit_levels(df: DataFrame, cols: list[str], as_int: bool = True) -> DataFrame:
    """Distinct levels of each column, NULL excluded, as (column, level).

    One pass for all columns; duplicates are removed within each task before the shuffle.
    """
    kind = "int" if as_int else "string"
    return (
        long_form(df, cols, cast=kind)
        .filter(F.col("value").isNotNull())
        .select("column", F.col("value").alias("level"))
        .distinct()
    )


def level_map(levels: DataFrame, cols: list[str] | None = None, max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """The level table as a plain dict, columns in the given order and levels ascending.

    The guard, of each column by itself, stops a key-like column from becoming an enormous schema.
    """
    wide = levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_levels).first()
    if wide:
        raise ValueError(f"{wide['column']} has {wide['n']} levels, more than {max_levels}; not a categorical column")
    rows = levels.orderBy("column", "level").collect()
    found: dict[str, list] = {}
    for r in rows:
        found.setdefault(r["column"], []).append(r["level"])
    order = cols if cols is not None else list(found)
    return {c: found.get(c, []) for c in order}


def one_hot(df: DataFrame, levels: dict[str, list] | DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One 0/1 column per level, all levels kept, sources dropped, in column then level order.

    A NULL or a level absent from the table gives zeros throughout.
    """
    if isinstance(levels, DataFrame):
        levels = level_map(levels, cols)
    sources = {c.lower() for c in levels}
    flags = [
        F.when(quoted(c) == F.lit(level), 1).otherwise(0).alias(f"{c}_{level}")
        for c, values in levels.items()
        for level in values
    ]
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in sources], *flags)


def fit_scaler(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and population standard deviation per column: (column, mean, std_pop). One pass."""
    stats = df.agg(
        *[F.avg(quoted(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(quoted(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std_pop")) for i, c in enumerate(cols)]
    return stats.select(F.inline(F.array(*rows)))


def scale(df: DataFrame, stats: DataFrame | dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std with fitted statistics; a constant column is only centred."""
    if isinstance(stats, DataFrame):
        stats = {r["column"]: (r["mean"], r["std_pop"]) for r in stats.collect()}

    def scaled(name):
        mean, std = stats[name]
        x = quoted(name).cast("double")
        return x if mean is None else (x - F.lit(mean)) / F.lit(std if std else 1.0)

    return df.withColumns({c: scaled(c) for c in df.columns if c in stats})
