"""Joining by key, exact splits and folds, class balancing.

Split and folds follow the fit / transform pattern: the order keys that separate the parts of each class are
found on the executors (`cut_table`) and joined by class, or become literals where there are no classes. While
that table is small it is broadcast, and the rows themselves are neither shuffled nor sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorepipe.functions.columns import quoted
from scorepipe.functions.keyed import hash_buckets, hash_int, hash_key, unit
from scorepipe.operators.neighbors import kept_neighbors
from scorepipe.sources.tables import settled
from scorepipe.operators.ordered import (
    at_or_before,
    class_sizes,
    cut_table,
    dense_index,
    offsets_before,
    order_cuts,
    parts_by_cuts,
    range_buckets,
)


def join_on_id(x: DataFrame, y: DataFrame, key: str) -> DataFrame:
    """Inner 1:1 join on the row key."""
    return x.join(y, key, "inner")


def union_bags(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def require_keys(df: DataFrame, key: str) -> None:
    """Raise when a row has no key: hash order could not place it, and it would fall out of some part silently."""
    if df.filter(quoted(key).isNull()).limit(1).count():
        raise ValueError(f"rows without {key}; give them keys first")


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.3, seed: int = 100, out: str = "split") -> DataFrame:
    """Add `split`: of each class exactly round(frac * n) rows, first in hash order, are 'test'. Keys must not be NULL."""
    require_keys(df, key)
    hashed = hash_key(seed, quoted(key))
    order = [hashed, quoted(key)]
    share = F.lit(float(test_frac))
    cuts = cut_table(df, label, order, hash_buckets(hashed), lambda _, n: [F.floor(share * n + F.lit(0.5).cast("double"))])
    parts = parts_by_cuts(df, label, order, cuts, 1, "_part")
    return parts.withColumn(out, F.when(F.col("_part") == 0, "test").otherwise("train")).drop("_part")


def _fold_column(order: list[Column], cuts: list[tuple | None]) -> Column:
    """Index of the first cut at or after the row; rows past the last cut are in the last fold."""
    fold = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        if cuts[i] is not None:
            fold = F.when(at_or_before(order, cuts[i]), i).otherwise(fold)
    return fold


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled folds 0..k-1 in hash order; the first n mod k folds hold one row more. Keys must not be NULL."""
    require_keys(df, key)
    hashed = hash_key(seed, quoted(key))
    order = [hashed, quoted(key)]

    def ends(_, n):
        """Rank of the last row of every fold but the final one."""
        return [F.floor(n / k) * i + F.least(F.lit(i), n % k) for i in range(1, k)]

    cuts = order_cuts(df, None, order, hash_buckets(hashed), ends).get(0, [None] * (k - 1))
    return df.withColumn(out, _fold_column(order, cuts))


def stratified_kfold(df: DataFrame, label: str, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Unshuffled stratified folds: each class is dealt in key order, in one run per fold.

    Run lengths follow the usual allocation: with the classes laid end to end, in order of first
    appearance, fold i takes every k-th place starting at i.
    """
    keys = df.select(quoted(label).alias("g"), quoted(key).alias("k"))
    classes = settled(keys.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("first")))
    ranged = range_buckets(classes, ["first"], "b")
    before = offsets_before(ranged.groupBy("b").agg(F.sum("n").alias("off")), [], "b", ["off"])
    upto = Window.partitionBy("b").orderBy("first", "g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranged.withColumn("end", F.sum("n").over(upto)).join(before, "b").withColumn("end", F.col("off") + F.col("end"))
    start = F.col("end") - F.col("n")

    def places(i: int) -> Column:
        """Places up to fold i of a class's stretch: those that leave a remainder of at most i by k."""
        held = [F.floor((F.col("end") - 1 - j) / k) - F.floor((start - 1 - j) / k) for j in range(i + 1)]
        return reduce(lambda a, b: a + b, held).cast("bigint")

    wants = settled(ends.select("g", F.array(*[places(i) for i in range(k - 1)]).alias("wants")))
    bucketed = range_buckets(keys, ["g", "k"], "b")
    cuts = cut_table(bucketed, "g", [F.col("k")], [F.col("b")], wants)
    return parts_by_cuts(df, label, [quoted(key)], cuts, k - 1, out)


def fold_frames(df: DataFrame, i: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(training rows, validation rows) of fold i."""
    return df.filter(quoted(fold) != i), df.filter(quoted(fold) == i)


def class_weight(df: DataFrame, label: str, pos_weight: float, out: str = "weight") -> DataFrame:
    weight = F.when(quoted(label) == 1, float(pos_weight)).otherwise(1.0).cast("double")
    return df.withColumn(out, weight)


def _minority(df: DataFrame, label: str) -> tuple[object, int, int]:
    """(minority class, its rows, majority rows) of a two-class frame."""
    sizes = class_sizes(df, label)
    if len(sizes) != 2:
        raise ValueError(f"{label} must have exactly two classes, found {sorted(sizes, key=str)}")
    (small, m), (_, big) = sorted(sizes.items(), key=lambda kv: (kv[1], str(kv[0])))
    return small, m, big


def oversample(df: DataFrame, label: str, key: str, seed: int = 42, target: int | None = None) -> DataFrame:
    """Majority rows plus `target` (default: as many) minority rows drawn with replacement.

    Adds `draw`: NULL for majority rows, the draw number otherwise, so that (key, draw) stays unique.
    Draw i takes the minority row with index hash(i) mod m; both sides of the join are spread evenly
    because the index is dense and the hash is uniform.
    """
    spark = df.sparkSession
    small, m, big = _minority(df, label)
    target = big if target is None else target
    index = dense_index(df.filter(quoted(label) == F.lit(small)), key, f"{seed}:row", "_idx")
    draws = spark.range(target).select(
        F.col("id").alias("draw"), (hash_int(hash_key(f"{seed}:draw", F.col("id"))) % m).alias("_idx")
    )
    drawn = index.join(draws, "_idx").drop("_idx")
    rest = df.filter(~quoted(label).eqNullSafe(F.lit(small))).withColumn("draw", F.lit(None).cast("bigint"))
    return rest.unionByName(drawn)


def smote(
    df: DataFrame, label: str, key: str, features: list[str], k: int = 5, seed: int = 100,
    target: int | None = None, keep_types: bool = True, block_rows: int = 4096,
) -> DataFrame:
    """All rows plus synthetic minority rows until the classes are equal (or the minority has `target` rows).

    A synthetic row lies at x + u * (neighbour - x): x a minority row, the neighbour one of its k
    nearest minority rows by Euclidean distance on the features as given, u in [0, 1); all three
    chosen by hash of the draw number. `keep_types` casts the values back to the column types, so
    integer features are truncated; otherwise all features become doubles.

    Adds `draw` (NULL for original rows). Synthetic rows have a NULL key and only features and label.
    """
    spark = df.sparkSession
    small, m, big = _minority(df, label)
    if m <= k:
        raise ValueError(f"{m} minority rows, but {k} neighbours need at least {k + 1}")
    total = (big if target is None else target) - m
    kinds = {f.name: f.dataType for f in df.schema.fields}
    bad = [quoted(c).isNull() | F.isnan(quoted(c).cast("double")) for c in features]
    if df.filter((quoted(label) == F.lit(small)) & reduce(lambda a, b: a | b, bad)).limit(1).count():
        raise ValueError("minority rows with a NULL or NaN feature have no neighbours; fill or drop them first")
    minority = df.filter(quoted(label) == F.lit(small)).select(
        quoted(key).alias("id"), F.array(*[quoted(c).cast("double") for c in features]).alias("vec")
    )
    near = kept_neighbors(minority, k, block_rows)
    index = dense_index(minority, "id", f"{seed}:row", "idx")
    draw = F.col("id")
    draws = spark.range(max(0, total)).select(
        draw.alias("draw"),
        (hash_int(hash_key(f"{seed}:base", draw)) % m).alias("idx"),
        (hash_int(hash_key(f"{seed}:near", draw)) % k + 1).cast("int").alias("rank"),
        unit(hash_key(f"{seed}:gap", draw)).alias("u"),
    )
    chosen = draws.join(index, "idx").join(near.select("id", "rank", "neighbor"), ["id", "rank"], "left")
    # a base row without listed neighbours is one of many copies: its neighbours are equal to it
    partner = F.coalesce("neighbor", "id").alias("other")
    other = minority.select(F.col("id").alias("other"), F.col("vec").alias("ovec"))
    made = chosen.select("draw", "u", "vec", partner).join(other, "other")

    def feature(i, c):
        x = F.get("vec", F.lit(i))
        value = x + F.col("u") * (F.get("ovec", F.lit(i)) - x)
        if not keep_types:
            return value.alias(c)
        if isinstance(kinds[c], T.IntegralType):
            value = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
        return value.cast(kinds[c]).alias(c)

    synthetic = made.select(
        F.lit(None).cast(kinds[key]).alias(key), *[feature(i, c) for i, c in enumerate(features)],
        F.lit(small).cast(kinds[label]).alias(label), "draw",
    )
    own = df.select(
        quoted(key), *[quoted(c) if keep_types else quoted(c).cast("double").alias(c) for c in features],
        quoted(label), F.lit(None).cast("bigint").alias("draw"),
    )
    return own.unionByName(synthetic)
