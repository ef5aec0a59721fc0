"""Evaluation of scored rows, always grouped by optional keys such as strategy or split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted, ratio
from scorepipe.operators.ordered import running_counts


def _by(by: list[str]) -> list[Column]:
    return [quoted(c) for c in by]


def accuracy(df: DataFrame, label: str, pred: str, by: list[str] = ()) -> DataFrame:
    hit = (quoted(label) == quoted(pred)).cast("double")
    return df.groupBy(*_by(by)).agg(F.avg(hit).alias("accuracy"))


def classes_of(df: DataFrame, label: str, pred: str) -> list:
    """All values of the labels and predictions, at least 0 and 1, in order. NULLs are no class."""
    pairs = df.select(F.explode(F.array(quoted(label), quoted(pred))).alias("c")).filter("c IS NOT NULL").distinct().collect()
    return sorted({0, 1} | {r["c"] for r in pairs}) if all(isinstance(r["c"], (int, float)) for r in pairs) else sorted(r["c"] for r in pairs)


def confusion(df: DataFrame, label: str, pred: str, by: list[str] = (), classes: list | None = None) -> DataFrame:
    """(by..., label, pred, n) on the full class grid, empty cells 0. One aggregation pass.

    Without given classes they are looked up, so that no row is left out of the total.
    """
    classes = classes_of(df, label, pred) if classes is None else classes
    grid = [(a, b) for a in classes for b in classes]
    sums = df.groupBy(*_by(by)).agg(*[
        F.coalesce(F.sum(((quoted(label) == a) & (quoted(pred) == b)).cast("bigint")), F.lit(0).cast("bigint")).alias(f"c{k}")
        for k, (a, b) in enumerate(grid)
    ])
    cells = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("pred"), F.col(f"c{k}").alias("n"))
        for k, (a, b) in enumerate(grid)
    ]
    return sums.select(*_by(by), F.inline(F.array(*cells)))


def class_report(df: DataFrame, label: str, pred: str, by: list[str] = (), classes: list | None = None) -> DataFrame:
    """(by..., class, precision, recall, f1, support), then accuracy, macro and weighted averages.

    A zero denominator gives 0. Everything after the one aggregation works on a row per group. Without
    given classes they are looked up, so that accuracy and support count every row.
    """
    classes = classes_of(df, label, pred) if classes is None else classes
    y, p = quoted(label), quoted(pred)

    def tally(cond):
        return F.coalesce(F.sum(cond.cast("bigint")), F.lit(0).cast("bigint"))

    sums = df.groupBy(*_by(by)).agg(
        *[tally((y == c) & (p == c)).alias(f"tp{i}") for i, c in enumerate(classes)],
        *[tally(p == c).alias(f"pp{i}") for i, c in enumerate(classes)],
        *[tally(y == c).alias(f"sup{i}") for i, c in enumerate(classes)],
    )

    def zero(x):
        return F.coalesce(x, F.lit(0.0).cast("double"))

    idx = range(len(classes))
    m = {}
    for i in idx:
        m[f"pr{i}"] = zero(ratio(F.col(f"tp{i}"), F.col(f"pp{i}")))
        m[f"re{i}"] = zero(ratio(F.col(f"tp{i}"), F.col(f"sup{i}")))
    wide = sums.withColumns(m).withColumns(
        {f"f{i}": zero(ratio(2 * F.col(f"pr{i}") * F.col(f"re{i}"), F.col(f"pr{i}") + F.col(f"re{i}"))) for i in idx}
    ).withColumns({
        "total": reduce(lambda a, b: a + b, [F.col(f"sup{i}") for i in idx]),
        "hits": reduce(lambda a, b: a + b, [F.col(f"tp{i}") for i in idx]),
    })

    def macro(name):
        return reduce(lambda a, b: a + b, [F.col(f"{name}{i}") for i in idx]) / len(classes)

    def weighted(name):
        return zero(ratio(reduce(lambda a, b: a + b, [F.col(f"{name}{i}") * F.col(f"sup{i}") for i in idx]), F.col("total")))

    def line(name, pr, re, f1, support):
        return F.struct(
            F.lit(str(name)).alias("class"), pr.alias("precision"), re.alias("recall"), f1.alias("f1"), support.alias("support")
        )

    acc = zero(ratio(F.col("hits"), F.col("total")))
    lines = [line(c, F.col(f"pr{i}"), F.col(f"re{i}"), F.col(f"f{i}"), F.col(f"sup{i}")) for i, c in enumerate(classes)]
    lines += [
        line("accuracy", acc, acc, acc, F.col("total")),
        line("macro avg", macro("pr"), macro("re"), macro("f"), F.col("total")),
        line("weighted avg", weighted("pr"), weighted("re"), weighted("f"), F.col("total")),
    ]
    return wide.select(*_by(by), F.inline(F.array(*lines)))


def averages(report: DataFrame) -> DataFrame:
    """Accuracy, macro and weighted rows of a class report."""
    return report.filter(F.col("class").isin("accuracy", "macro avg", "weighted avg"))


def run_metrics(report: DataFrame, by: list[str] = ()) -> DataFrame:
    """The named metrics a run is logged with: one row per group of a 0/1 class report."""

    def pick(cls, field):
        return F.max(F.when(F.col("class") == cls, F.col(field)))

    return report.groupBy(*_by(by)).agg(
        pick("accuracy", "f1").alias("accuracy"),
        pick("macro avg", "precision").alias("precision_macro"),
        pick("macro avg", "recall").alias("recall_macro"),
        pick("macro avg", "f1").alias("f1_macro"),
        pick("0", "recall").alias("recall_no_default"),
        pick("1", "recall").alias("recall_default"),
    )


def rank_metrics(df: DataFrame, label: str, score: str, by: list[str] = (), buckets: int | None = None) -> DataFrame:
    """(by..., n_pos, n_neg, auc, gini, ks_roc, ks_2samp), exact, ties counted half.

    `ks_roc` is one-sided, the largest tpr - fpr; `ks_2samp` is two-sided, the largest distance of
    the two score distributions. All are NULL when a class is missing.
    """
    by = list(by)
    rows = running_counts(df, label, score, by, buckets)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    gap = ratio(F.col("tp"), p) - ratio(F.col("fp"), n)
    # negatives strictly below the score, plus half of those level with it
    beaten = (n - F.col("fp")) + F.col("n_neg") / F.lit(2.0).cast("double")
    out = rows.groupBy(*_by(by)).agg(
        F.sum("n_pos").alias("n_pos"),
        F.sum("n_neg").alias("n_neg"),
        F.sum(F.col("n_pos") * beaten).alias("u"),
        F.greatest(F.max(gap), F.lit(0.0).cast("double")).alias("top_gap"),
        F.max(F.abs(gap)).alias("wide_gap"),
    )
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    area = ratio(F.col("u"), F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))
    return out.select(
        *_by(by), "n_pos", "n_neg", area.alias("auc"), (2 * area - 1).alias("gini"),
        F.when(both, F.col("top_gap")).alias("ks_roc"), F.when(both, F.col("wide_gap")).alias("ks_2samp"),
    )


def auc(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    return rank_metrics(df, label, score, by).select(*_by(by), "auc")


def gini(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    return rank_metrics(df, label, score, by).select(*_by(by), "gini")


def ks_roc(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    return rank_metrics(df, label, score, by).select(*_by(by), "ks_roc")


def ks_2samp(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    return rank_metrics(df, label, score, by).select(*_by(by), "ks_2samp")


def label_auc(df: DataFrame, label: str, pred: str, by: list[str] = ()) -> DataFrame:
    """AUC of hard 0/1 labels, which is (TPR + TNR) / 2: four conditional sums, no ordering."""
    y, p = quoted(label), quoted(pred)

    def tally(cond):
        return F.sum(cond.cast("bigint"))

    out = df.groupBy(*_by(by)).agg(
        tally((y == 1) & (p == 1)).alias("tp"), tally(y == 1).alias("pos"),
        tally((y != 1) & (p != 1)).alias("tn"), tally(y != 1).alias("neg"),
    )
    area = (ratio(F.col("tp"), F.col("pos")) + ratio(F.col("tn"), F.col("neg"))) / 2
    return out.select(*_by(by), area.alias("label_auc"))


def roc_curve(
    df: DataFrame, label: str, score: str, by: list[str] = (), drop_collinear: bool = True, buckets: int | None = None
) -> DataFrame:
    """(by..., threshold, fpr, tpr) with a leading (0, 0) at an infinite threshold.

    `drop_collinear` leaves out points on a straight stretch: those whose step equals the next one.
    The first and the last score are always kept.
    """
    by = list(by)
    rows = running_counts(df, label, score, by, buckets)
    first = (F.col("tp") == F.col("n_pos")) & (F.col("fp") == F.col("n_neg"))
    points = rows
    if drop_collinear:
        last = F.col("next_pos").isNull()
        bend = (F.col("next_pos") != F.col("n_pos")) | (F.col("next_neg") != F.col("n_neg"))
        points = rows.filter(first | last | bend)
    point = F.struct(
        F.col("score").alias("threshold"), ratio(F.col("fp"), F.col("n")).alias("fpr"), ratio(F.col("tp"), F.col("p")).alias("tpr")
    )
    zero = F.lit(0.0).cast("double")
    origin = F.struct(F.lit(float("inf")).alias("threshold"), zero.alias("fpr"), zero.alias("tpr"))
    # the highest score of a group brings the origin with it
    return points.select(*_by(by), F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def predict_label(df: DataFrame, score: str = "score", threshold: float = 0.5, out: str = "pred") -> DataFrame:
    """1 when the score is strictly above the threshold; a row without a score (NULL or NaN) has no label."""
    s = quoted(score)
    known = s.isNotNull() & ~F.isnan(s.cast("double"))
    return df.withColumn(out, F.when(known, F.when(s > F.lit(threshold), 1).otherwise(0)))


# Published reading guides, as (metric, lower limit, label); the highest met limit applies.
GUIDE_BANDS = [("ks", 0.0, "weak"), ("ks", 0.4, "good"), ("gini", 0.0, "weak"), ("gini", 0.6, "good")]
RETAIL_BANDS = [
    ("ks", 0.0, "below threshold"), ("ks", 0.3, "validated"), ("ks", 0.43, "strong"),
    ("gini", 0.0, "below standard"), ("gini", 0.4, "standard"),
]


def band(metrics: DataFrame, bands: list[tuple[str, float, str]] = GUIDE_BANDS, metric: str = "metric", value: str = "value") -> DataFrame:
    """Add `band`: the label of the highest limit strictly below the value, the lowest label otherwise."""
    out = F.lit(None).cast("string")
    for name in sorted({b[0] for b in bands}):
        limits = sorted([b for b in bands if b[0] == name], key=lambda b: b[1])
        label = F.lit(limits[0][2])
        for _, low, text in limits[1:]:
            label = F.when(quoted(value) > F.lit(low), F.lit(text)).otherwise(label)
        out = F.when((quoted(metric) == name) & quoted(value).isNotNull(), label).otherwise(out)
    return metrics.withColumn("band", out)


def to_long(metrics: DataFrame, names: list[str], by: list[str] = ()) -> DataFrame:
    """Wide metric columns to (by..., metric, value)."""
    cells = [F.struct(F.lit(n).alias("metric"), quoted(n).cast("double").alias("value")) for n in names]
    return metrics.select(*_by(by), F.inline(F.array(*cells)))


def compare_runs(metrics: DataFrame, baseline: str, names: list[str], run: str = "run") -> DataFrame:
    """One row per run with each metric and its difference to the baseline run.

    Input is long (run, metric, value). The names are fixed, so the pivot needs no extra pass.
    """
    cells = [F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]
    wide = metrics.groupBy(quoted(run)).agg(*cells)
    base = wide.filter(quoted(run) == baseline).agg(*[F.max(quoted(n)).alias(n) for n in names])
    refs = base.select(F.struct(*[quoted(n) for n in names])).scalar()
    return wide.withColumn("_base", refs).select(
        quoted(run), *[quoted(n) for n in names],
        *[(quoted(n) - F.col("_base")[n]).alias(f"{n}_delta") for n in names],
    )


def evaluate(scored: DataFrame, label: str = "label", score: str = "score", pred: str = "pred", by: list[str] = ("split",)) -> DataFrame:
    """(by..., accuracy, auc): train and test of one model side by side from one scored frame."""
    by = list(by)
    acc = accuracy(scored, label, pred, by)
    area = auc(scored, label, score, by)
    cond = reduce(lambda a, b: a & b, [acc[c].eqNullSafe(area[c]) for c in by])
    return acc.join(area, cond).select(*[acc[c] for c in by], "accuracy", "auc")
