"""Legal input that once gave silently wrong rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorepipe.operators import encode, metrics, neighbors, risk, sampling
from scorepipe.plans.tracking import RunStore


def test_rows_without_keys_are_refused(spark):
    df = spark.range(20).select(F.when(F.col("id") > 5, F.col("id")).alias("id"), (F.col("id") % 2).alias("y"))
    for f in (lambda: sampling.stratified_split(df, "y", "id"), lambda: sampling.kfold(df, "id")):
        with pytest.raises(ValueError):
            f()


def test_synthetic_rows_need_whole_features(spark):
    df = spark.createDataFrame([(i, float(i) if i != 3 else None, int(i < 10)) for i in range(40)], "id BIGINT, x DOUBLE, y INT")
    with pytest.raises(ValueError):
        sampling.smote(df, "y", "id", ["x"])


def test_other_classes_count(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "label INT, pred INT")
    assert metrics.confusion(df, "label", "pred").agg(F.sum("n")).first()[0] == 3
    report = {r["class"]: r for r in metrics.class_report(df, "label", "pred").collect()}
    assert report["accuracy"]["f1"] == pytest.approx(2 / 3) and report["accuracy"]["support"] == 3 and report["2"]["support"] == 1


def test_level_guard_is_per_column(spark):
    df = spark.range(600).select(F.col("id").cast("int").alias("a"), (F.col("id") % 500).cast("int").alias("b"))
    levels = encode.level_map(encode.fit_levels(df, ["a", "b"]), ["a", "b"])
    assert (len(levels["a"]), len(levels["b"])) == (600, 500)
    with pytest.raises(ValueError):
        encode.level_map(encode.fit_levels(df, ["a", "b"]), ["a", "b"], max_levels=599)


def test_runs_are_not_mixed(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "runs"))
    for experiment, name, value in (("e", "A", 0.9), ("e", "B", 0.8), ("f", "A", 0.2), ("e", "A", 0.7)):
        store.log_metrics(store.start_run(experiment, name), {"accuracy": value})
    with pytest.raises(ValueError):
        store.compare("A", ["accuracy"])
    got = {r["run"]: r["accuracy"] for r in store.compare("A", ["accuracy"], "e").collect()}
    assert got == {"A": 0.7, "B": 0.8}


def test_decisions_from_scores(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.2, 0), (None, 1)], "score DOUBLE, label INT")
    known = df.filter("score IS NOT NULL")
    best = risk.best_threshold(risk.threshold_costs(known, "label", "score", 1, 5)).first()
    assert (best["threshold"], best["cost"]) == (0.7, 1.0)
    assert risk.reliability(df, "label", "score").agg(F.sum("n")).first()[0] == 4
    lift = {r["part"]: r for r in risk.lift_table(known, "label", "score", 2).collect()}
    assert lift[2]["gain"] == 1 and lift[2]["lift"] == 1 and lift[1]["n_rows"] == 2
    model = risk.calibrate(known, "label", "score")
    fitted = [r["calibrated"] for r in model.transform(known).orderBy("score").collect()]
    assert fitted == sorted(fitted)
    assert risk.stability(known, known, "score").agg(F.sum("psi")).first()[0] == pytest.approx(0)
    assert risk.time_split(df.withColumn("t", F.lit(None).cast("timestamp")), "t").filter("split = 'test'").count() == 0


@pytest.mark.parametrize("kind", ["whole", "far", "huge", "missing"])
def test_near_rows_come_from_a_product_and_are_exact(kind, monkeypatch):
    """Distances and ties are those of the plain sums; these are taken only where the product could overflow."""
    rng = np.random.default_rng(3)
    q, c = np.round(rng.normal(size=(300, 6)), 1), np.round(rng.normal(size=(400, 6)), 1)
    if kind == "far":
        q, c = q + 1e7, c + 1e7
    if kind == "huge":
        c[::3] *= 1e160
    if kind == "missing":
        c[::3, 1] = np.nan
    qid, cid = np.arange(300), rng.permutation(500)[:400] // 2
    with np.errstate(all="ignore"):
        d = neighbors.squared_distances(q, c)
        want = []
        for i in range(300):
            near = sorted((d[i, j], cid[j]) for j in range(400) if cid[j] != qid[i] and np.isfinite(d[i, j]))[:5]
            want += [(i, b, a) for a, b in near]
        if kind in ("whole", "far"):
            monkeypatch.delattr(neighbors, "squared_distances")
        got = neighbors.nearest_in_block(qid, q, cid, c, 5)
    assert list(got.itertuples(index=False, name=None)) == want
