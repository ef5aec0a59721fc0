import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorepipe.operators import metrics
from scorepipe.operators.ordered import running_counts


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label INT, score DOUBLE")


def pair_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y != 1]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def ks_by_hand(pairs):
    pos = np.array([s for y, s in pairs if y == 1])
    neg = np.array([s for y, s in pairs if y != 1])
    cuts = sorted({s for _, s in pairs})
    gaps = [(pos >= c).mean() - (neg >= c).mean() for c in cuts]
    return max(max(gaps), 0.0), max(abs(g) for g in gaps)


@pytest.mark.parametrize(
    "pairs, auc, one, two",
    [
        ([(i >= 5, i) for i in range(10)], 1.0, 1.0, 1.0),
        ([(i < 5, i) for i in range(10)], 0.0, 0.0, 1.0),
        ([(i % 2, 7) for i in range(10)], 0.5, 0.0, 0.0),
    ],
)
def test_extreme_scores(spark, pairs, auc, one, two):
    r = metrics.rank_metrics(scored(spark, pairs), "label", "score").first()
    assert (r["auc"], r["ks_roc"], r["ks_2samp"]) == (auc, one, two)
    assert r["gini"] == 2 * auc - 1


def test_single_class_and_empty(spark):
    r = metrics.rank_metrics(scored(spark, [(0, 1), (0, 2)]), "label", "score").first()
    assert r["auc"] is None and r["gini"] is None and r["ks_roc"] is None and r["ks_2samp"] is None
    empty = metrics.rank_metrics(scored(spark, [(0, 1)]).limit(0), "label", "score", ["label"])
    assert empty.count() == 0 and "auc" in empty.columns


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), st.integers(-6, 6)), min_size=2, max_size=40).filter(
    lambda x: len({y for y, _ in x}) == 2), st.integers(2, 9))
def test_rank_metrics_against_pairs(spark, pairs, buckets):
    df = scored(spark, pairs)
    r = metrics.rank_metrics(df, "label", "score", buckets=buckets).first()
    assert r["auc"] == pytest.approx(pair_auc(pairs))
    one, two = ks_by_hand(pairs)
    assert r["ks_roc"] == pytest.approx(one) and r["ks_2samp"] == pytest.approx(two)
    assert 0 <= r["ks_roc"] <= r["ks_2samp"] <= 1
    flipped = metrics.rank_metrics(df.withColumn("score", -F.col("score")), "label", "score", buckets=buckets).first()
    assert flipped["auc"] == pytest.approx(1 - r["auc"]) and flipped["ks_2samp"] == pytest.approx(r["ks_2samp"])
    bent = metrics.rank_metrics(df.withColumn("score", F.exp(F.col("score") / 3)), "label", "score").first()
    assert bent["ks_roc"] == pytest.approx(r["ks_roc"])


def test_hot_score_and_groups(spark):
    """A third of the rows share one score; groups may be NULL."""
    rng = np.random.default_rng(1)
    data = [(None if i % 7 == 0 else i % 2, int(rng.random() < 0.3), 0.5 if i % 3 == 0 else float(rng.random())) for i in range(3000)]
    df = spark.createDataFrame(data, "g INT, label INT, score DOUBLE")
    got = {r["g"]: r["auc"] for r in metrics.rank_metrics(df, "label", "score", ["g"], buckets=16).collect()}
    for g in (None, 0, 1):
        assert got[g] == pytest.approx(pair_auc([(y, s) for k, y, s in data if k == g]))


def test_running_counts_are_global(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(rng.random() < 0.4), round(float(rng.normal()), 1)) for _ in range(500)]
    got = running_counts(scored(spark, pairs), "label", "score", buckets=8).orderBy(F.desc("score")).toPandas()
    pdf = pd.DataFrame(pairs, columns=["y", "s"]).groupby("s")["y"].agg(["sum", "count"]).sort_index(ascending=False)
    assert got["tp"].tolist() == pdf["sum"].cumsum().tolist()
    assert got["fp"].tolist() == (pdf["count"] - pdf["sum"]).cumsum().tolist()
    assert got["next_pos"].dropna().tolist() == pdf["sum"].tolist()[1:]


def roc_by_hand(pairs, drop):
    pos, neg = sum(y == 1 for y, _ in pairs), sum(y != 1 for y, _ in pairs)
    pts = []
    for c in sorted({s for _, s in pairs}, reverse=True):
        pts.append((c, sum(y != 1 and s >= c for y, s in pairs), sum(y == 1 and s >= c for y, s in pairs)))
    if drop and len(pts) > 2:
        keep = [0] + [i for i in range(1, len(pts) - 1) if any(
            pts[i + 1][a] - 2 * pts[i][a] + pts[i - 1][a] for a in (1, 2))] + [len(pts) - 1]
        pts = [pts[i] for i in keep]
    return [(math.inf, 0.0, 0.0)] + [(c, f / neg, t / pos) for c, f, t in pts]


@pytest.mark.parametrize("drop", [True, False])
def test_roc_curve(spark, drop):
    rng = np.random.default_rng(5)
    pairs = [(int(rng.random() < 0.3), round(float(rng.random()), 2)) for _ in range(300)]
    got = metrics.roc_curve(scored(spark, pairs), "label", "score", drop_collinear=drop, buckets=8).orderBy(F.desc("threshold")).collect()
    want = roc_by_hand(pairs, drop)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g) == pytest.approx(w)


def test_report_and_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "label INT, pred INT")
    assert rows(metrics.confusion(df, "label", "pred")) == [(0, 0, 2), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    rep = {r["class"]: r for r in metrics.class_report(df, "label", "pred").collect()}
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["f1"], rep["1"]["support"]) == (0.5, 0.5, 0.5, 2)
    assert rep["accuracy"]["f1"] == 0.6 and rep["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert rep["weighted avg"]["recall"] == pytest.approx(0.6) and rep["weighted avg"]["support"] == 5
    named = metrics.run_metrics(metrics.class_report(df, "label", "pred")).first()
    assert named["recall_default"] == 0.5 and named["accuracy"] == 0.6


def test_never_predicted_class(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label INT, pred INT")
    rep = {r["class"]: r for r in metrics.class_report(df, "label", "pred").collect()}
    assert rep["1"]["precision"] == 0 and rep["1"]["f1"] == 0


def test_label_auc_is_auc_of_labels(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in rng.integers(0, 2, (200, 2))], "label INT, pred INT")
    a = metrics.label_auc(df, "label", "pred").first()[0]
    assert a == pytest.approx(metrics.auc(df, "label", "pred").first()[0])


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.51,), (None,), (float("nan"),)], "score DOUBLE")
    assert [r["pred"] for r in metrics.predict_label(df).collect()] == [0, 1, None, None]


def test_bands_and_comparison(spark):
    m = spark.createDataFrame([("ks", 0.43), ("ks", 0.4), ("gini", 0.61), ("ks", None), ("x", 1.0)], "metric STRING, value DOUBLE")
    assert [r["band"] for r in metrics.band(m).collect()] == ["good", "weak", "good", None, None]
    assert [r["band"] for r in metrics.band(m, metrics.RETAIL_BANDS).collect()][:2] == ["validated", "validated"]
    long = spark.createDataFrame([("a", "acc", 0.8), ("b", "acc", 0.7), ("a", "rec", 0.3)], "run STRING, metric STRING, value DOUBLE")
    got = {r["run"]: r for r in metrics.compare_runs(long, "a", ["acc", "rec"]).collect()}
    assert got["b"]["acc_delta"] == pytest.approx(-0.1) and got["b"]["rec"] is None and got["a"]["rec_delta"] == 0
