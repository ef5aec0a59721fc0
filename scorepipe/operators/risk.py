"""Decisions from scores: thresholds with costs, lift, calibration, drift between samples, evidence of levels, splits in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import long_form, quoted, ratio
from scorepipe.operators.isotonic import calibrated, isotonic_blocks
from scorepipe.operators.ordered import running_counts


def threshold_costs(df: DataFrame, label: str, score: str, fp_cost: float, fn_cost: float, by: list[str] = ()) -> DataFrame:
    """(by..., threshold, fp, fn, cost) for each distinct score, when rows at or above it are taken as positive."""
    rows = running_counts(df, label, score, list(by))
    fn = F.col("p") - F.col("tp")
    cost = F.col("fp") * F.lit(float(fp_cost)) + fn * F.lit(float(fn_cost))
    return rows.select(*[quoted(c) for c in by], F.col("score").alias("threshold"), F.col("fp"), fn.alias("fn"), cost.alias("cost"))


def best_threshold(costs: DataFrame, by: list[str] = ()) -> DataFrame:
    """The cheapest threshold of each group, the highest one on a tie."""
    best = F.min(F.struct("cost", (-F.col("threshold")).alias("back"), "fp", "fn")).alias("b")
    return costs.groupBy(*[quoted(c) for c in by]).agg(best).select(
        *[quoted(c) for c in by], (-F.col("b.back")).alias("threshold"), "b.fp", "b.fn", "b.cost"
    )


def lift_table(df: DataFrame, label: str, score: str, parts: int = 10, by: list[str] = ()) -> DataFrame:
    """(by..., part, n_rows, gain, lift): cumulative from the highest score down; equal scores stay together.

    A part ends with the last score whose rows reach into it, so shares are those of whole scores.
    """
    rows = running_counts(df, label, score, list(by)).withColumn("all", F.col("p") + F.col("n")).withColumn("upto", F.col("tp") + F.col("fp"))
    part = F.expr(f"({parts} * CAST(upto AS BIGINT) + CAST(all AS BIGINT) - 1) div CAST(all AS BIGINT)")
    ends = rows.withColumn("part", part.cast("int")).groupBy(*[quoted(c) for c in by], "part").agg(
        F.max("upto").cast("bigint").alias("n_rows"), F.max("tp").alias("tp"), F.max("p").alias("p"), F.max("all").alias("all")
    )
    gain = ratio(F.col("tp"), F.col("p"))
    return ends.select(*[quoted(c) for c in by], "part", "n_rows", gain.alias("gain"), ratio(gain, ratio(F.col("n_rows"), F.col("all"))).alias("lift"))


def score_bin(score: Column, bins: int) -> Column:
    """Bin 0.. of a probability, all of the same width; what lies outside the unit interval goes to the outer bins."""
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(score * bins))).cast("int")


def reliability(df: DataFrame, label: str, score: str, bins: int = 10, by: list[str] = ()) -> DataFrame:
    """(by..., bin, n, mean_score, rate, brier): how often the event comes true where the score promises it.

    brier is the bin's sum of squared errors over its rows. Rows without score or label are left out.
    """
    s, y = quoted(score), quoted(label).cast("double")
    known = df.filter(s.isNotNull() & ~F.isnan(s) & y.isNotNull())
    return known.groupBy(*[quoted(c) for c in by], score_bin(s, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean_score"), F.avg(y).alias("rate"), F.avg((s - y) * (s - y)).alias("brier")
    )


def calibrate(df: DataFrame, label: str, score: str) -> Calibration:
    """A fitted isotonic map from scores to probabilities; `transform` adds `calibrated`."""
    return Calibration(isotonic_blocks(df, label, score), score)


class Calibration:
    def __init__(self, blocks: DataFrame, score: str):
        self.blocks, self.score = blocks, score

    def transform(self, df: DataFrame) -> DataFrame:
        return calibrated(df, self.blocks, self.score)


def stability(expected: DataFrame, actual: DataFrame, score: str, bins: int = 10, least: float = 1e-4) -> DataFrame:
    """(bin, expected, actual, psi): shares of two samples in each bin and the bin's part of the population stability index.

    An empty bin counts as a share of ``least``. The index is the sum of psi over the bins.
    """
    grid = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    base = expected.sparkSession.range(1).select(grid)

    def shares(df, name):
        n = df.filter(quoted(score).isNotNull() & ~F.isnan(quoted(score))).groupBy(score_bin(quoted(score), bins).alias("bin")).agg(F.count(F.lit(1)).alias("k"))
        share = ratio(F.col("k"), F.sum("k").over(Window.partitionBy()))  # over the bins, not the rows
        return base.join(n, "bin", "left").select("bin", F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(least)).alias(name))

    both = shares(expected, "expected").join(shares(actual, "actual"), "bin")
    return both.withColumn("psi", (F.col("actual") - F.col("expected")) * F.log(F.col("actual") / F.col("expected")))


def weight_of_evidence(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """(column, level, n_pos, n_neg, woe, iv) of every level; half a row is added so that no level is infinite.

    The information value of a column is the sum of iv over its levels. NULL is a level of its own.
    """
    long = long_form(df, cols, keep=[label], cast="string")
    y = quoted(label)
    counts = long.groupBy("column", F.coalesce("value", F.lit("(null)")).alias("level")).agg(
        F.sum((y == 1).cast("bigint")).alias("n_pos"), F.sum((y != 1).cast("bigint")).alias("n_neg")
    )
    whole = Window.partitionBy("column")
    p, n = F.sum("n_pos").over(whole), F.sum("n_neg").over(whole)
    half = F.lit(0.5).cast("double")
    woe = F.log(((F.col("n_pos") + half) / (p + half)) / ((F.col("n_neg") + half) / (n + half)))
    iv = (ratio(F.col("n_pos"), p) - ratio(F.col("n_neg"), n)) * woe
    return counts.select("column", "level", "n_pos", "n_neg", woe.alias("woe"), iv.alias("iv"))


def time_cut(df: DataFrame, time: str, test_frac: float = 0.3):
    """First day of the test part: the earliest from which at most ``test_frac`` of the rows follow. None without rows."""
    days = df.filter(quoted(time).isNotNull()).groupBy(F.to_date(quoted(time)).alias("day")).agg(F.count(F.lit(1)).alias("k"))
    # one row a day, so this window is as small as the calendar
    later = days.select("day", F.sum("k").over(Window.orderBy(F.col("day").desc())).alias("from_here"), F.sum("k").over(Window.partitionBy()).alias("all"))
    return later.filter(F.col("from_here") <= F.lit(float(test_frac)) * F.col("all")).agg(F.min("day")).first()[0]


def time_split(df: DataFrame, time: str, test_frac: float = 0.3, out: str = "split") -> DataFrame:
    """Add `split`: rows from the cut day on are 'test', earlier ones and those without a time 'train'."""
    cut = time_cut(df, time, test_frac)
    late = F.lit(False) if cut is None else F.coalesce(F.to_date(quoted(time)) >= F.lit(cut), F.lit(False))
    return df.withColumn(out, F.when(late, "test").otherwise("train"))
