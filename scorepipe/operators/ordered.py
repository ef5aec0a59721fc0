"""Global order without a one-task window.

Every operator here cuts the key range into buckets, reduces the data to small per-bucket totals, and sorts only
inside buckets. Boundaries steer the balance of the tasks and never the result, so approximate quantiles are good
enough for them. They are literals of the plan or written with the rows: a recomputed task meets the same buckets
again. The number of buckets follows the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted
from scorepipe.functions.keyed import hash_key
from scorepipe.sources.tables import settled

MAX_BUCKETS = 4096
MAX_CLASSES = 1000
RANGE_ROWS = 1 << 18
"""Rows of a sorted range that one task ranks; the number of ranges follows the rows."""
OFFSET_ROWS = 4096
"""Buckets whose sums one window adds up."""
LITERAL_CUTS = 64
"""Cuts up to this many become literals of the plan."""
BROADCAST_ROWS = 10_000
"""Tables of cuts and offsets up to this many rows are broadcast; larger ones are joined by a shuffle."""


def bucket_target(df: DataFrame) -> int:
    """A few buckets per shuffle partition; the cap bounds every per-bucket table."""
    return min(MAX_BUCKETS, max(8, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def range_bounds(df: DataFrame, col: str, buckets: int | None = None, share: float = 0.1) -> list[float]:
    """Inner bucket boundaries of a numeric column: approximate quantiles of a sample, at most MAX_BUCKETS."""
    buckets = buckets or bucket_target(df)
    probs = [i / buckets for i in range(1, buckets)]
    found = df.sample(share, 17).agg(F.percentile_approx(quoted(col).cast("double"), probs, 10 * buckets)).first()[0]
    return sorted({float(v) for v in found or [] if v is not None and math.isfinite(v)})


def with_range_bucket(df: DataFrame, col: str, bounds: list[float], out: str) -> DataFrame:
    """Bucket number of a double column, increasing with the value; NaN comes last, as in a sort."""
    if not bounds:
        return df.withColumn(out, F.when(F.isnan(quoted(col)), 1.0).otherwise(0.0))
    splits = [float("-inf"), *bounds, float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(df)


def range_buckets(df: DataFrame, cols: list[str], out: str, buckets: int | None = None, rows_each: int = RANGE_ROWS) -> DataFrame:
    """Add bucket numbers that grow with the columns' order, of about ``rows_each`` rows; as many as the rows need.

    The buckets are the ranges of a sort, written with the rows, so every later step meets the same ones.
    """
    buckets = buckets or -(-df.count() // rows_each)
    if buckets <= 1:
        return df.withColumn(out, F.lit(0))
    return settled(df.repartitionByRange(buckets, *[quoted(c) for c in cols]).withColumn(out, F.spark_partition_id()))


def offsets_before(totals: DataFrame, by: list[str], at: str, values: list[str], width: int = OFFSET_ROWS) -> DataFrame:
    """(by..., at, values...): of each bucket ``at`` (a whole number, one row per group) the sums over the group's lower buckets.

    A window holds at most ``width`` buckets. More are summed by their hundreds or thousands first, those sums again
    in the same way, and a bucket adds what lies before its own thousand.
    """
    top = totals.agg(F.max(at)).first()[0]
    within = Window.partitionBy(*by, F.floor(F.col(at) / width)).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(v).over(within), F.lit(0)).alias(v) for v in values]
    inside = totals.select(*by, F.col(at), *sums)
    if top is None or top < width:
        return inside
    up = at + "_up"
    upper = totals.groupBy(*by, F.floor(F.col(at) / width).alias(up)).agg(*[F.sum(v).alias(v) for v in values])
    before = offsets_before(settled(upper), by, up, values, width)
    before = before.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(by)], up, *[F.col(v).alias(f"_up_{v}") for v in values])
    same = F.floor(F.col(at) / width) == F.col(up)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return inside.join(before, same).select(*by, at, *[(F.col(v) + F.col(f"_up_{v}")).alias(v) for v in values])


def _null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def running_counts(df: DataFrame, label: str, score: str, by: list[str] = (), buckets: int | None = None) -> DataFrame:
    """Per distinct score, from the highest down: its own and the running class counts.

    Output: by..., score, n_pos, n_neg, tp, fp (running, own row included), p, n (totals),
    next_pos, next_neg (counts at the next lower score, NULL at the end).

    Equal scores collapse to one row inside each task, so a score that a third of the rows share
    costs nothing. The only row-sized shuffles carry distinct scores. Rows without a label or a
    score take no part.
    """
    by = list(by)
    s, y = quoted(score).cast("double"), quoted(label)
    rows = df.filter(quoted(label).isNotNull() & quoted(score).isNotNull()).select(
        *[quoted(c) for c in by], s.alias("score"), y.alias("_y")
    )
    counts = rows.groupBy(*by, "score").agg(
        F.sum((F.col("_y") == 1).cast("bigint")).alias("n_pos"),
        F.sum((F.col("_y") != 1).cast("bigint")).alias("n_neg"),
    )
    counts = range_buckets(settled(counts), [*by, "score"], "bucket", buckets)

    # one row for each range of 2^18 scores
    per_bucket = counts.groupBy(*by, "bucket").agg(
        F.sum("n_pos").alias("b_pos"),
        F.sum("n_neg").alias("b_neg"),
        F.max_by(F.struct("n_pos", "n_neg"), "score").alias("first"),
    )
    down = Window.partitionBy(*by).orderBy(F.desc("bucket"))
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_bucket.select(
        *by, "bucket",
        F.coalesce(F.sum("b_pos").over(before), F.lit(0)).alias("off_pos"),
        F.coalesce(F.sum("b_neg").over(before), F.lit(0)).alias("off_neg"),
        F.sum("b_pos").over(whole).alias("p"),
        F.sum("b_neg").over(whole).alias("n"),
        F.lead("first").over(down).alias("follower"),
    )
    inside = Window.partitionBy(*by, "bucket").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counts.withColumns({
        "tp": F.sum("n_pos").over(upto),
        "fp": F.sum("n_neg").over(upto),
        "next_row": F.lead(F.struct("n_pos", "n_neg")).over(inside),
    })
    joined = local.join(offsets, _null_safe(local, offsets, [*by, "bucket"]), "inner")
    follower = F.coalesce(local["next_row"], offsets["follower"])
    return joined.select(
        *[local[c] for c in by], local["score"], local["n_pos"], local["n_neg"],
        (local["tp"] + offsets["off_pos"]).alias("tp"),
        (local["fp"] + offsets["off_neg"]).alias("fp"),
        offsets["p"], offsets["n"],
        follower["n_pos"].alias("next_pos"), follower["n_neg"].alias("next_neg"),
    )


def dense_index(df: DataFrame, key: str, seed: int | str, out: str = "idx", rows_each: int = RANGE_ROWS) -> DataFrame:
    """Add 0..n-1 in hash order of the key (which must be unique).

    The leading digits of the hash are the bucket, as many as keep a bucket at about ``rows_each`` rows.
    """
    digits, n = 0, df.count()
    while n > rows_each * 16**digits:
        digits += 1
    at = F.conv(F.substring(F.col("_h"), 1, digits), 16, 10).cast("bigint") if digits else F.lit(0).cast("bigint")
    hashed = df.withColumn("_h", hash_key(seed, quoted(key))).withColumn("_b", at)
    sizes = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_off"))
    offsets = offsets_before(settled(sizes) if digits else sizes, [], "_b", ["_off"])
    side = F.broadcast(offsets) if 16**digits <= BROADCAST_ROWS else offsets
    inside = Window.partitionBy("_b").orderBy("_h", quoted(key))
    ranked = hashed.withColumn("_rn", F.row_number().over(inside))
    return ranked.join(side, "_b").withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_b", "_h", "_rn", "_off")


def class_sizes(df: DataFrame, label: str | None) -> dict[object, int]:
    """Rows per class; a label with more than MAX_CLASSES values is refused."""
    g = F.lit(0) if label is None else quoted(label)
    rows = df.groupBy(g.alias("g")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    return {r["g"]: r["n"] for r in rows}


def cut_table(
    df: DataFrame, label: str | None, order: list[Column], buckets: list[Column],
    ranks: Callable[[Column, Column], list[Column]] | DataFrame, rank_rows: int = 2_000_000,
) -> DataFrame:
    """(g, cut, k0, ...): the order keys at given ranks of each class, a row per class and rank above 0.

    ``ranks(class, class size)`` lists the wanted 1-based ranks as columns; or they come as a frame (g, wants), an
    array for each class. ``buckets`` are ever finer parts of the order.

    Scans of the key columns and no sort of the data: bucket counts locate the bucket that holds a rank, finer
    buckets are counted only inside located ones that hold more than ``rank_rows`` rows, and only the rows of the
    last located bucket are ranked. Nothing grows on the driver, however many classes there are.
    """
    g = F.lit(0) if label is None else quoted(label)
    keys = [f"k{i}" for i in range(len(order))]
    levels = [f"b{i}" for i in range(len(buckets))]
    rows = df.select(
        g.alias("g"), *[c.alias(b) for c, b in zip(buckets, levels)], *[c.alias(k) for c, k in zip(order, keys)]
    )
    sizes = rows.groupBy("g", "b0").agg(F.count(F.lit(1)).alias("n"))
    per_class = Window.partitionBy("g")
    cum = sizes.select(
        "g", "b0", "n", F.sum("n").over(per_class.orderBy("b0")).alias("upto"), F.sum("n").over(per_class).alias("total")
    )
    if isinstance(ranks, DataFrame):
        wants = ranks.select(F.col("g").alias("wg"), "wants")
        cum = cum.join(wants, F.col("g").eqNullSafe(F.col("wg")))
    else:
        cum = cum.withColumn("wants", F.array(*[r.cast("bigint") for r in ranks(F.col("g"), F.col("total"))]))
    before = F.col("upto") - F.col("n")
    held = (F.col("want") > before) & (F.col("want") <= F.col("upto"))
    hits = cum.select("*", F.posexplode("wants").alias("cut", "want")).filter(held)
    hits = settled(hits.select("g", "b0", "cut", (F.col("want") - before).alias("rn"), "n"))

    def members(found, level):
        """Rows of the located buckets, once per cut they serve."""
        small = found.select(F.col("g").alias("pg"), F.col(level).alias("pb"), "cut", "rn")
        small = F.broadcast(small) if found.count() <= BROADCAST_ROWS else small
        return rows.join(small, F.col("g").eqNullSafe(F.col("pg")) & (F.col(level) == F.col("pb")))

    out = None
    for level, name in enumerate(levels):
        finer = levels[level + 1] if level + 1 < len(levels) else None
        ready = hits.filter(F.col("n") <= rank_rows) if finer else hits
        place = F.row_number().over(Window.partitionBy("g", "cut").orderBy(*keys))
        placed = members(ready, name).withColumn("place", place).filter(F.col("place") == F.col("rn")).select("g", "cut", *keys)
        out = placed if out is None else out.unionByName(placed)
        crowded = hits.filter(F.col("n") > rank_rows)
        if finer is None or not crowded.take(1):
            break
        counted = members(crowded, name).groupBy("g", "cut", "rn", finer).agg(F.count(F.lit(1)).alias("n"))
        counted = counted.withColumn("upto", F.sum("n").over(Window.partitionBy("g", "cut").orderBy(finer)))
        located = counted.filter((F.col("rn") > before) & (F.col("rn") <= F.col("upto")))
        hits = settled(located.select("g", finer, "cut", (F.col("rn") - before).alias("rn"), "n"))
    return settled(out)


def order_cuts(
    df: DataFrame, label: str | None, order: list[Column], buckets: list[Column],
    ranks: Callable[[Column, Column], list[Column]], rank_rows: int = 2_000_000,
) -> dict[object, list[tuple | None]]:
    """`cut_table` as {class: [key of each rank]} for a label with few classes; rank 0 has no key (None)."""
    sizes = class_sizes(df, label)
    keys = [f"k{i}" for i in range(len(order))]
    n = len(ranks(F.lit(0), F.lit(0)))
    cuts: dict[object, list[tuple | None]] = {c: [None] * n for c in sizes}
    for r in cut_table(df, label, order, buckets, ranks, rank_rows).collect():
        cuts[r["g"]][r["cut"]] = tuple(r[k] for k in keys)
    return cuts


def parts_by_cuts(df: DataFrame, label: str, order: list[Column], cuts: DataFrame, n: int, out: str) -> DataFrame:
    """Add the number of the first cut of its class at or after each row, n past the last one.

    Few cuts become literals. More are joined by class, broadcast while the table is small, so that the rows are not shuffled.
    """
    few = cuts.limit(LITERAL_CUTS + 1).collect()
    if len(few) <= LITERAL_CUTS:
        part = F.lit(n)
        for r in sorted(few, key=lambda r: -r["cut"]):
            part = F.when(quoted(label).eqNullSafe(F.lit(r["g"])) & at_or_before(order, tuple(r)[2:]), r["cut"]).otherwise(part)
        return df.withColumn(out, part)
    keys = [f"k{i}" for i in range(len(order))]
    key = F.struct(*keys)
    wide = cuts.groupBy(F.col("g").alias("_g")).agg(*[F.max(F.when(F.col("cut") == i, key)).alias(f"_c{i}") for i in range(n)])
    wide = settled(wide)
    side = F.broadcast(wide) if wide.count() <= BROADCAST_ROWS else wide
    own = F.struct(*[c.alias(k) for c, k in zip(order, keys)])
    part = F.lit(n)
    for i in reversed(range(n)):
        part = F.when(own <= F.col(f"_c{i}"), i).otherwise(part)
    joined = df.join(side, quoted(label).eqNullSafe(F.col("_g")), "left")
    return joined.select(*[quoted(c) for c in df.columns], part.alias(out))


def at_or_before(order: list[Column], cut: tuple) -> Column:
    """Lexicographic `order <= cut`."""
    cond = order[-1] <= F.lit(cut[-1])
    for c, v in zip(reversed(order[:-1]), reversed(cut[:-1])):
        cond = (c < F.lit(v)) | ((c == F.lit(v)) & cond)
    return cond


def order_statistics(
    df: DataFrame, cols: list[str], probs: list[float], rank_rows: int = 1_000_000, sample_rows: int = 1_000_000
) -> DataFrame:
    """Exact quantiles with linear interpolation: (column, prob, value), NULL and NaN left out.

    Every wanted rank gets a bracket of values. While a bracket holds more than `rank_rows` rows, a
    sketch over a sample of its rows proposes three values, and exact counts of the rows below and at each
    of them decide where the rank lies: on the middle value, which is then the answer, or between two of
    them. The values at the ends leave the bracket when the rank lies beyond all their rows, so a value
    that most rows share holds nothing up. Only values inside the last brackets are ranked. The sample
    steers how fast brackets shrink; the answer does not depend on it.
    """
    spark = df.sparkSession
    x = df.select(*[F.nanvl(quoted(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)])
    sizes = x.agg(*[F.count(c).alias(c) for c in x.columns]).first()
    steps = []  # one per column and probability that has rows
    for c, name in zip(x.columns, cols):
        for p in probs if sizes[c] else []:
            at = (sizes[c] - 1) * p
            steps.append({
                "x": c, "column": name, "prob": float(p), "lo": -math.inf, "hi": math.inf, "below": 0, "upto": sizes[c],
                "r1": math.floor(at) + 1, "r2": math.ceil(at) + 1, "part": at - math.floor(at), "open": True,
            })
    if not steps:
        return spark.createDataFrame([], "column STRING, prob DOUBLE, value DOUBLE")
    while active := [s for s in steps if s["open"] and s["upto"] - s["below"] > rank_rows]:
        fraction = min(1.0, sample_rows / max(s["upto"] - s["below"] for s in active))
        seen = x if fraction == 1.0 else x.sample(fraction, 17)
        asks = []
        for k, s in enumerate(active):
            m = s["upto"] - s["below"]
            slack = 2.0 / math.sqrt(max(1.0, m * fraction)) + 2.0 / 10_000
            s["ask"] = [(s["r1"] - s["below"] - 1) / m - slack, (s["r1"] - s["below"]) / m, (s["r2"] - s["below"]) / m + slack]
            marks = ", ".join(str(min(1.0, max(0.0, q))) + "D" for q in s["ask"])
            asks.append(f"percentile_approx(IF({_inside(s)}, {s['x']}, NULL), array({marks}), 10000) AS q{k}")
        found = seen.selectExpr(*asks).first()
        for k, s in enumerate(active):
            q = found[f"q{k}"] or [s["lo"], s["lo"], s["hi"]]
            s["try"] = (q[0] if s["ask"][0] > 0 else s["lo"], q[1], q[2] if s["ask"][2] < 1 else s["hi"])
        counted = x.selectExpr(*[
            e
            for k, s in enumerate(active)
            for i, v in enumerate(s["try"])
            for e in (f"count_if({s['x']} < {_double(v)}) AS below{k}_{i}", f"count_if({s['x']} <= {_double(v)}) AS upto{k}_{i}")
        ]).first()
        for k, s in enumerate(active):
            was = s["upto"] - s["below"]
            below, upto = ([counted[f"{side}{k}_{i}"] for i in range(3)] for side in ("below", "upto"))
            for i, v in enumerate(s["try"]):
                if s["below"] <= upto[i] < s["r1"] and v >= s["lo"]:  # the ranks lie above all rows of this value
                    s["lo"], s["below"] = math.nextafter(v, math.inf), upto[i]
                elif s["below"] <= below[i] < s["r1"] and v >= s["lo"]:
                    s["lo"], s["below"] = v, below[i]
                if s["r2"] <= below[i] <= s["upto"] and v <= s["hi"]:  # and below all rows of this one
                    s["hi"], s["upto"] = math.nextafter(v, -math.inf), below[i]
                elif s["r2"] <= upto[i] <= s["upto"] and v <= s["hi"]:
                    s["hi"], s["upto"] = v, upto[i]
            s["open"] = s["upto"] - s["below"] < was and s["lo"] < s["hi"]
    brackets: dict[str, tuple[int, str]] = {}
    for s in steps:
        s["r1"] -= s["below"]
        s["r2"] -= s["below"]
        s["k"] = brackets.setdefault(_inside(s), (len(brackets), s["x"]))[0]

    # the cells inside each bracket; ranks that share a bracket share its cells
    cells = ", ".join(f"IF({cond}, struct({k} AS k, {c} AS v), NULL)" for cond, (k, c) in brackets.items())
    inside = x.selectExpr(f"inline(array({cells}))").filter("k IS NOT NULL").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = spark.createDataFrame(
        [(s["k"], s["column"], s["prob"], s["r1"], s["r2"], float(s["part"])) for s in steps],
        "k INT, column STRING, prob DOUBLE, r1 BIGINT, r2 BIGINT, part DOUBLE",
    )
    ranked = inside.withColumn("upto", F.sum("n").over(w)).withColumn("before", F.col("upto") - F.col("n"))
    held = ranked.join(F.broadcast(table), "k")

    def at_rank(r):
        return F.max(F.when((F.col("before") < F.col(r)) & (F.col(r) <= F.col("upto")), F.col("v")))

    return held.groupBy("column", "prob", "part").agg(at_rank("r1").alias("v1"), at_rank("r2").alias("v2")).select(
        "column", "prob", (F.col("v1") + (F.col("v2") - F.col("v1")) * F.col("part")).alias("value")
    )


def _double(v: float) -> str:
    return f"double('{v}')"


def _inside(step: dict) -> str:
    return f"{step['x']} BETWEEN {_double(step['lo'])} AND {_double(step['hi'])}"
