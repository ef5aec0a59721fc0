import math

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from scorepipe.operators import profile


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "a": rng.normal(1e6, 3, 997), "b": rng.integers(0, 5, 997).astype(float), "c": np.full(997, 0.1),
        "d": np.where(rng.random(997) < 0.3, np.nan, rng.normal(size=997)),
    })
    df = spark.createDataFrame(pdf)
    return pdf, df.withColumn("d", F.when(~F.isnan("d"), F.col("d")))


def test_value_counts(spark):
    df = spark.createDataFrame([(v,) for v in [3, 1, 1, 2, 2, None]], "x INT")
    assert [tuple(r) for r in profile.value_counts(df, "x").collect()] == [(None, 1), (1, 2), (2, 2), (3, 1)]
    assert [tuple(r) for r in profile.value_counts(df, "x", "count").collect()] == [(1, 2), (2, 2), (None, 1), (3, 1)]


def test_null_profile_counts_nan_apart(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, None), (1.0, 2)], "x DOUBLE, y INT")
    assert rows(profile.null_profile(df)) == [("x", 1, 1), ("y", 1, 0)]
    empty = df.limit(0)
    assert rows(profile.null_profile(empty)) == [("x", 0, 0), ("y", 0, 0)]
    assert profile.null_profile(df.select(F.lit(1).alias("z")), only_found=True).count() == 0


def test_describe_matches_pandas(frame):
    pdf, df = frame
    got = {(r["column"], r["stat"]): r["value"] for r in profile.describe(df).collect()}
    want = pdf.describe()
    assert len(got) == want.size
    for c in want:
        for s in want.index:
            assert got[(c, s)] == pytest.approx(want.loc[s, c], rel=1e-9, abs=1e-9)


def test_describe_survives_a_bad_sketch(frame):
    """With tiny samples the proposed brackets miss, and the answer stays exact."""
    from scorepipe.operators.ordered import order_statistics

    pdf, df = frame
    got = {(r["column"], r["prob"]): r["value"] for r in order_statistics(df, ["a", "b", "d"], [0.0, 0.1, 0.5, 0.99, 1.0], 20, 30).collect()}
    for c in ("a", "b", "d"):
        for p in (0.0, 0.1, 0.5, 0.99, 1.0):
            assert got[(c, p)] == pytest.approx(pdf[c].quantile(p), rel=1e-12)


def test_describe_empty(spark):
    df = spark.createDataFrame([], "x DOUBLE")
    got = {r["stat"]: r["value"] for r in profile.describe(df).collect()}
    assert got["count"] == 0 and got["mean"] is None


def test_histogram_matches_numpy(frame):
    pdf, df = frame
    got = profile.histogram(df, ["a", "b", "c", "d"], 10).toPandas()
    for c in pdf:
        n, edges = np.histogram(pdf[c].dropna(), bins=10)
        g = got[got.column == c].sort_values("bin")
        assert g["n"].tolist() == n.tolist(), c
        assert np.allclose(g["lo"], edges[:-1]) and np.allclose(g["hi"], edges[1:])


def test_corr_matches_pandas(frame):
    pdf, df = frame
    got = {(r["a"], r["b"]): r["r"] for r in profile.corr_matrix(df).collect()}
    want = pdf.corr()
    for a in want:
        for b in want:
            if "c" in (a, b):
                assert got[(a, b)] is None
            else:
                assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-9)


def test_parity_rate_distribution_delta(spark):
    before = spark.createDataFrame([(i, i % 4 == 0) for i in range(20)], "id INT, y BOOLEAN").withColumn("y", F.col("y").cast("int"))
    after = before.filter("id < 18")
    assert rows(profile.count_parity(before, after)) == [(20, 18, 2, False)]
    assert rows(profile.count_parity(before, before)) == [(20, 20, 0, True)]
    assert profile.label_rate(before, "y").first()[0] == 0.25
    assert rows(profile.class_distribution(before, "y")) == [(0, 15, 75.0), (1, 5, 25.0)]
    assert rows(profile.schema_delta(before, after.withColumn("z", F.lit(1)), ("id",), ("id",))) == [(1, 2, 1)]


def test_cv_summary(spark):
    s = spark.createDataFrame([(0.5,), (0.7,), (0.9,)], "score DOUBLE")
    n, mean, sd, var = profile.cv_summary(s).first()
    assert n == 3 and math.isclose(mean, 0.7) and math.isclose(sd, np.std([0.5, 0.7, 0.9])) and math.isclose(var, 0.04)


def test_dq_report(spark):
    parent = spark.createDataFrame([(i, i % 2) for i in range(4)], "id INT, y INT")
    child = parent.filter("id > 0").withColumn("x", F.when(F.col("id") > 1, 1))
    got = {(r["check"], r["column"]): (r["value"], r["passed"]) for r in profile.dq_report(child, parent, "y").collect()}
    assert got[("null_count", "x")] == (1.0, False) and got[("null_count", "id")] == (0.0, True)
    assert got[("row_count", None)] == (3.0, False) and got[("lost_rows", None)] == (1.0, False)
    assert got[("positive_rate", "y")][0] == pytest.approx(2 / 3)


def test_top_k(spark):
    df = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "id INT, g INT, v INT")
    assert [r["id"] for r in profile.top_k(df, "v", 3, "id").collect()] == [4, 9, 14]
    assert profile.top_k(df, "v", 2, "id", ["g"]).count() == 6


@pytest.mark.parametrize("heavy", [0.0, 49.0, 50.0, 99.0])
def test_a_value_that_most_rows_share_holds_nothing_up(spark, heavy):
    from scorepipe.operators.ordered import order_statistics

    rng = np.random.default_rng(8)
    x = np.concatenate([np.full(6000, heavy), rng.random(4000) * 100])
    rng.shuffle(x)
    df = spark.createDataFrame([(float(v),) for v in x], "x DOUBLE")
    probs = [0.0, 0.01, 0.25, 0.5, 0.599, 0.6, 0.61, 0.75, 0.999, 1.0]
    got = {r["prob"]: r["value"] for r in order_statistics(df, ["x"], probs, rank_rows=3, sample_rows=500).collect()}
    assert [got[p] for p in probs] == pytest.approx(np.quantile(x, probs).tolist())
