"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Counts are taken inside each row. The rates that follow from them are compared within language and source:
minimum-covariance-determinant estimates (the rows whose covariance has the smallest determinant) by
concentration steps. A step measures the Mahalanobis distance of every row, keeps the nearest share of each
group, and takes their mean and covariance. The cut of a group is found on a fixed logarithmic grid of distances,
so a step is two aggregates that combine inside the tasks, whatever share of the rows a group holds. Sums are
exact integers: the estimates do not depend on how the rows are dealt.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.llm import common

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words

SCALE = 10_000
"""Rates are rounded to this part of one."""
NEAREST = 0.75
STEPS = 4
LEAST_ROWS = 25
RATES = [("word_length", 0.5), ("symbols", 0.1), ("dup_lines", 0.2), ("repeats", 0.1)]
"""Transformed statistics with the least standard deviation that counts: most texts have none of the last three at all.
Every statistic can reach the cut-off by itself at these."""


def chi_square(x: float, degrees: int) -> float:
    """Share of a chi-square distribution below x, for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(degrees // 2))


def chi_square_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, degrees) < share else (low, mid)
    return high


CUTOFF = chi_square_quantile(0.999, len(RATES))
"""Squared distance beyond which a row is an outlier: this quantile at four degrees, 18.5."""


def consistency(nearest: float) -> float:
    """What the covariance of the nearest share of normal rows is multiplied by to be that of all of them."""
    p = len(RATES)
    return nearest / chi_square(chi_square_quantile(nearest, p), p + 2)


GROUP = ["lang", "source"]
FITTED = ["level", *GROUP]
"""Names of an estimate: see ``levels``; what a level does not tell apart is empty."""


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    k = WINDOW_WORDS
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP], text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda s: s.rlike(WORD))
    rows = rows.select(
        "doc_id", *GROUP, F.filter(F.split("text", WORD_GAP, -1), lambda w: w != "").alias("w"), F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"), lines.alias("lines")
    )
    at = F.when(F.size("w") >= k, F.sequence(F.lit(0), F.size("w") - k)).otherwise(F.array().cast("array<int>"))
    rows = rows.select(
        "doc_id", *GROUP, "n_symbols", F.size("w").cast("bigint").alias("n_words"), F.char_length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"), F.size("lines").cast("bigint").alias("n_lines"),
        F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("w"), i + j) for j in range(k)])).alias("h"),
        F.length(F.bin(F.size("w"))).alias("bits"),
    )
    # hash and position in one long, so that sorting brings equal windows together; the few neighbours are then compared by the whole hash
    packed = rows.withColumn("s", F.sort_array(F.transform("h", lambda h, i: _pack(h, i))))
    near = F.filter("s", lambda x, j: F.coalesce(_high(F.get("s", j + 1)) == _high(x), F.lit(False)) | F.coalesce(_high(F.get("s", j - 1)) == _high(x), F.lit(False)))
    some = packed.withColumn("c", F.transform(near, _low))
    # named twice, so that the optimizer keeps the hashes in a column and does not take them anew for each element
    whole = F.array_sort(F.transform("c", lambda p: F.struct(F.get("h", p).alias("h"), p.alias("p"))))
    some = some.withColumn("c", F.when(F.size("h") > 0, whole).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")))
    same = F.filter("c", lambda x, j: F.coalesce(F.get("c", j + 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("c", j - 1)["h"] == x["h"], F.lit(False)))
    some = some.withColumn("p", F.sort_array(F.transform(same, lambda x: x["p"])))
    fresh = F.transform("p", lambda p, j: F.least(F.lit(k), F.coalesce(F.get("p", j + 1) - p, F.lit(k))))
    covered = F.aggregate(fresh, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return some.select("doc_id", *GROUP, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"), "n_lines")


def _pack(h: Column, i: Column) -> Column:
    return F.call_function("shiftleft", F.call_function("shiftright", h, F.col("bits")), F.col("bits")).bitwiseOR(i.cast("bigint"))


def _high(x: Column) -> Column:
    return F.call_function("shiftright", x, F.col("bits"))


def _low(x: Column) -> Column:
    return (x - F.call_function("shiftleft", _high(x), F.col("bits"))).cast("int")


def rates(counted: DataFrame) -> DataFrame:
    """Adds base_failed and the transformed statistics x0.. as integers of 1 / SCALE."""
    n = F.greatest("n_words", F.lit(1)).cast("double")
    values = [F.col("word_chars") / n, F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select("*", failed.alias("base_failed"), *[F.round(v * SCALE).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)])


def moments(rows: DataFrame, keys: list[str], factor: float = 1.0) -> DataFrame:
    """Mean m0.. and the lower triangle l00, l10, l11.. of the Cholesky factor of the covariance times ``factor``, per
    group and start; a variance is the least one that counts at least."""
    p = range(len(RATES))
    wide = "decimal(38,0)"
    sums = [F.sum(F.col(f"x{i}").cast(wide)).alias(f"s{i}") for i in p]
    sums += [F.sum((F.col(f"x{i}") * F.col(f"x{j}")).cast(wide)).alias(f"q{i}{j}") for i in p for j in range(i + 1)]
    n = F.col("n").cast("double")
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
    mean = [F.col(f"s{i}").cast("double") / n / SCALE for i in p]

    def covariance(i, j):
        c = factor * (F.col(f"q{i}{j}").cast("double") / n / SCALE / SCALE - mean[i] * mean[j])
        return (F.greatest(c, F.lit(RATES[i][1] ** 2)) if i == j else c).alias(f"c{i}{j}")

    out = out.select(*keys, "n", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[covariance(i, j) for i in p for j in range(i + 1)])
    return factored(out, keys)


def factored(out: DataFrame, keys: list[str]) -> DataFrame:
    """Cholesky factor of c.. as columns, one column at a time, and its log determinant."""
    p = range(len(RATES))
    for i in p:
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") - reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    det = reduce(lambda a, b: a + b, [2 * F.log(F.col(f"l{i}{i}")) for i in p])
    return out.select(*keys, "n", *[f"m{i}" for i in p], *[f"l{i}{j}" for i in p for j in range(i + 1)], det.alias("log_det"))


def distance(p: int = len(RATES)) -> Column:
    """Squared Mahalanobis distance of x0.. under the joined m.. and l.."""
    solved: list[Column] = []
    for i in range(p):
        rest = F.col(f"x{i}").cast("double") / SCALE - F.col(f"m{i}")
        for j, y in enumerate(solved):
            rest = rest - F.col(f"l{i}{j}") * y
        solved.append(rest / F.col(f"l{i}{i}"))
    return reduce(lambda a, b: a + b, [y * y for y in solved])


def quantile_bucket(cells: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, cut): the first bucket up to which at least ``share`` of a group's rows lie. Buckets of a group are few."""
    sizes = cells.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("k"))
    up_to = Window.partitionBy(*keys).orderBy("bucket")
    running = sizes.select(*keys, "bucket", F.sum("k").over(up_to).alias("run"), F.sum("k").over(Window.partitionBy(*keys)).alias("all"))
    return running.filter(F.col("run") >= share * F.col("all")).groupBy(*keys).agg(F.min("bucket").alias("cut"))


def grid(value: Column) -> Column:
    """Sixteen buckets to an octave, from 2^-20 up."""
    return F.floor(16 * F.log2(F.greatest(value, F.lit(2.0**-20)))).cast("int")


def levels(sound: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(lang, source, size, level, wide): whose estimate judges a group's rows, its own (0), its language's (1) or that of all rows (2).

    It is the first that has ``least_rows`` rows, null where even the table has fewer; ``wide`` says that some
    group of the language needs more than its own.
    """
    sizes = sound.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size"))
    by_lang = sizes.groupBy("lang").agg(F.sum("size").alias("n"), (F.min("size") < least_rows).alias("wide"))
    level = F.when(F.col("size") >= least_rows, 0).when(F.col("n") >= least_rows, 1).when(F.lit(sound.count() >= least_rows), 2)
    return sizes.join(by_lang, "lang").select(*GROUP, "size", level.alias("level"), (F.col("wide") & (F.col("n") >= least_rows)).alias("wide"))


def at_levels(sound: DataFrame, placed: DataFrame) -> DataFrame:
    """The statistics of each row once for every estimate that is needed and that it belongs to."""
    top = bool(placed.filter("level = 2").head(1))
    at = [(F.col("level") == 0, "lang", "source"), (F.col("wide"), "lang", None), (F.lit(top), None, None)]
    cells = [F.when(on, F.struct(F.lit(i).alias("level"), *[(F.col(c) if c else F.lit("")).alias(g) for g, c in zip(GROUP, key)])) for i, (on, *key) in enumerate(at)]
    xs = [f"x{i}" for i in range(len(RATES))]
    return sound.join(placed, GROUP).select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("at"), *xs).select("at.*", *xs)


def middle_start(rows: DataFrame) -> DataFrame:
    """A start from the medians and the median distances to them, each statistic on its own."""
    p = range(len(RATES))
    long = rows.select(*FITTED, F.posexplode(F.array(*[f"x{i}" for i in p])).alias("i", "x"))
    middle = quantile_bucket(long.withColumn("bucket", grid(F.col("x") / SCALE + 1)), [*FITTED, "i"], 0.5)
    middle = middle.select(*FITTED, "i", (F.pow(F.lit(2.0), (F.col("cut") + 0.5) / 16) - 1).alias("m"))
    away = long.join(middle, [*FITTED, "i"]).withColumn("bucket", grid(F.abs(F.col("x") / SCALE - F.col("m"))))
    spread = quantile_bucket(away, [*FITTED, "i"], 0.5).select(*FITTED, "i", (1.4826 * F.pow(F.lit(2.0), (F.col("cut") + 1) / 16)).alias("d"))
    both = middle.join(spread, [*FITTED, "i"]).groupBy(*FITTED).agg(*[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}") for i in p for c in ("m", "d")])
    cells = [(F.greatest(F.pow(F.col(f"d{i}"), 2), F.lit(RATES[i][1] ** 2)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in p for j in range(i + 1)]
    return factored(both.select(*FITTED, F.lit(1).alias("start"), F.lit(0).cast("bigint").alias("n"), *[f"m{i}" for i in p], *cells), [*FITTED, "start"])


def covariances(rows: DataFrame, nearest: float = NEAREST, steps: int = STEPS) -> DataFrame:
    """Per group the estimate with the smallest determinant of two starts: all rows, and the medians."""
    keys = [*FITTED, "start"]
    now = common.settled(moments(rows.withColumn("start", F.lit(0)), keys).unionByName(middle_start(rows)))
    for _ in range(steps):
        placed = rows.join(now, FITTED).select(*keys, *[f"x{i}" for i in range(len(RATES))], grid(distance()).alias("bucket"))
        cut = quantile_bucket(placed, keys, nearest)
        now = common.settled(moments(placed.join(cut, keys).filter("bucket <= cut"), keys, consistency(nearest)))
    best = Window.partitionBy(*FITTED).orderBy("log_det", "start")
    return now.withColumn("place", F.row_number().over(best)).filter("place = 1").drop("place", "start", "n")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, nearest: float = NEAREST, least_rows: int = LEAST_ROWS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance) of every row.

    Rows that fail the base rules take no part in the estimates and are not kept. A language and source with fewer
    than ``least_rows`` others is judged by the estimate of its language, a language with fewer by that of all rows;
    only where the whole table has fewer is nothing more rejected (distance is null). A null language or source
    counts as an empty one. Null texts have no words. Repeated rows and null ids give a row each; extra columns are
    ignored; an empty table gives no rows.
    """
    rows = common.settled(rates(counts(docs)))
    sound = rows.filter("NOT base_failed")
    placed = common.settled(levels(sound, least_rows))
    fitted = covariances(common.settled(at_levels(sound, placed)), nearest)
    judged = rows.join(placed.drop("size", "wide"), GROUP, "left")
    judged = judged.withColumn("lang", F.when(F.col("level") < 2, F.col("lang")).otherwise("")).withColumn("source", F.when(F.col("level") == 0, F.col("source")).otherwise(""))
    judged = judged.join(fitted, FITTED, "left").withColumn("distance", F.when(~F.col("base_failed"), distance()))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
