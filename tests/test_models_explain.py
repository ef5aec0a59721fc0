import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorepipe.operators import explain, metrics, models, sampling
from scorepipe.plans import layers, tracking, training
from scorepipe.queries.base import FEATURES, KEY, LABEL
from scorepipe.session import work_path


@pytest.fixture(scope="module")
def parts(gold):
    s = sampling.stratified_split(gold, LABEL, KEY).persist()
    return s.filter("split = 'train'").drop("split"), s.filter("split = 'test'").drop("split")


@pytest.fixture(scope="module")
def boosted(parts):
    return models.fit_gbt(parts[0], FEATURES, LABEL, {**models.TUNED["Normal Sampling"], "max_depth": 3}, rounds=4)


def newton(x, y, c):
    """Minimise C * log loss + w.w / 2, intercept free."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(a.shape[1]), np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve(c * (a.T * (p * (1 - p))) @ a + ridge, c * a.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-12:
            break
    return w


def test_logistic_solves_the_penalised_problem(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.0] + 0.3)))).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=range(400), y=y)
    fitted = models.fit_logistic(spark.createDataFrame(pdf), ["a", "b", "c"], "y", c=0.5, tol=1e-12)
    got = {r["feature"]: r["weight"] for r in models.coefficients(fitted).collect()}
    assert [got[k] for k in ("intercept", "a", "b", "c")] == pytest.approx(list(newton(x, y, 0.5)), abs=1e-5)


def test_score_linear(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a DOUBLE, b DOUBLE")
    got = models.score_linear(df, {"a": 0.5, "b": -1.0}, 0.25).first()["score"]
    assert got == pytest.approx(1 / (1 + math.exp(1.25)))


def test_logistic_beats_chance_and_scores_are_whole(parts):
    train, test = parts
    model, prepare = models.scaled_logistic(train, FEATURES, LABEL)
    scored = models.score(model, prepare(test), KEY)
    assert scored.count() == test.count() and scored.filter("score < 0 OR score > 1").count() == 0
    assert metrics.auc(scored, "label", "score").first()[0] > 0.65


def test_cross_validation_scales_inside_folds(parts):
    folds = sampling.stratified_kfold(parts[0], LABEL, KEY, 3).persist()
    got = models.cross_validate(folds, models.scaled_logistic, FEATURES, LABEL, KEY, "accuracy", 3)
    scores = [r["score"] for r in got.collect()]
    assert len(scores) == 3 and all(0.6 < s < 1 for s in scores)
    with pytest.raises(ValueError):
        models.cross_validate(folds, models.scaled_logistic, FEATURES, LABEL, KEY, "x", 3)


def test_tuned_trees_grow(parts):
    """At the tuned settings most trees split and many features are used."""
    model = models.fit_gbt(parts[0], FEATURES, LABEL, models.TUNED["Normal Sampling"], 20)
    trees = model.core.trees
    assert sum(t.numNodes > 1 for t in trees) > 0.8 * len(trees)
    assert (model.core.featureImportances.toArray() > 0).sum() > len(FEATURES) / 2


def test_saved_logistic_scores_raw_rows(spark, parts, tmp_path):
    from scorepipe.plans.tracking import RunStore

    train, test = parts
    model, _ = models.scaled_logistic(train, FEATURES, LABEL)
    store = RunStore(spark, str(tmp_path / "store"))
    assert store.table("models").count() == 0
    model_id = store.log_model(store.start_run("e", "lr"), model, "lr")
    a, b = (models.score(m, test, KEY).toPandas().set_index("id")["score"].sort_index() for m in (model, store.load_model(model_id)))
    assert np.allclose(a, b) and b.std() > 0.01
    name = store.score_table(model_id, test, KEY, "scored_by_test")
    assert spark.read.table(name).count() == test.count()
    with pytest.raises(KeyError):
        store.load_model("m-none")


def test_random_draws_are_distinct_and_repeatable():
    a = models.random_draws(models.SEARCH_SPACE, 200, 1)
    assert len(a) == 200 == len({tuple(d.items()) for d in a}) and a == models.random_draws(models.SEARCH_SPACE, 200, 1)
    assert len(models.random_draws({"x": [1, 2]}, 9)) == 2


def test_random_search(parts):
    folds = sampling.kfold(parts[0], KEY, 2)
    space = {"max_depth": [2, 3], "learning_rate": [0.1]}
    got = models.random_search(folds, FEATURES, LABEL, KEY, space, n=2, k=2, rounds=2).toPandas()
    assert len(got) == 2 and got.best.sum() == 1 and got.loc[got.best, "mean"].iloc[0] == got["mean"].max()


def margin_of(nodes, x):
    """Log-odds by walking the trees."""
    by = {(r["tree"], r["node"]): r for r in nodes}
    total = 0.0
    for t in {r["tree"] for r in nodes}:
        r = by[(t, 0)]
        while r["left"] >= 0:
            r = by[(t, r["left"] if x[r["feature"]] <= r["threshold"] else r["right"])]
        total += r["tree_weight"] * r["value"]
    return 2 * total


def test_tree_shap_adds_up_to_the_log_odds(parts, boosted):
    test = parts[1]
    shap = explain.tree_shap(boosted, test, KEY, keep=[LABEL]).toPandas().set_index("id")
    p = models.score(boosted, test, KEY).toPandas().set_index("id")["score"].loc[shap.index]
    total = shap.base_value + shap.contributions.map(sum)
    assert np.allclose(total, np.log(p / (1 - p)), atol=1e-9)
    assert LABEL in shap.columns and len(shap) == test.count()


def test_leaf_passes_give_the_same(parts, boosted, monkeypatch):
    test = parts[1].limit(20).persist()
    a = explain.tree_shap(boosted, test, KEY).orderBy("id").collect()
    monkeypatch.setattr(explain, "MAX_LEAF_CELLS", 20)
    b = explain.tree_shap(boosted, test, KEY).orderBy("id").collect()
    assert np.allclose([r["contributions"] for r in a], [r["contributions"] for r in b])


def conditional(nodes, tree, x, known):
    """Tree value when only some features are known; the others follow the training cover."""
    by = {r["node"]: r for r in nodes if r["tree"] == tree}

    def walk(n):
        r = by[n]
        if r["left"] < 0:
            return 2 * r["tree_weight"] * r["value"]
        if r["feature"] in known:
            return walk(r["left"] if x[r["feature"]] <= r["threshold"] else r["right"])
        return sum(by[c]["cover"] * walk(c) for c in (r["left"], r["right"])) / r["cover"]

    return walk(0)


def test_tree_shap_against_subset_enumeration(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(rng.normal(size=(300, 4)), columns=list("abcd"))
    pdf["y"] = ((pdf.a > 0) ^ (pdf.b * pdf.c > 0.2)).astype(int)
    pdf["id"] = range(300)
    df = spark.createDataFrame(pdf)
    fitted = models.fit_gbt(df, list("abcd"), "y", {"max_depth": 4, "scale_pos_weight": 3}, rounds=3)
    nodes = explain.tree_nodes(fitted).collect()
    trees = {r["tree"] for r in nodes}
    some = df.filter("id < 12")
    for r in explain.tree_shap(fitted, some, "id").collect():
        x = pdf.loc[pdf.id == r["id"], list("abcd")].to_numpy()[0]
        want = np.zeros(4)
        for i in range(4):
            rest = [j for j in range(4) if j != i]
            for n in range(4):
                for s in itertools.combinations(rest, n):
                    w = math.factorial(n) * math.factorial(3 - n) / math.factorial(4)
                    want[i] += w * sum(conditional(nodes, t, x, {*s, i}) - conditional(nodes, t, x, set(s)) for t in trees)
        assert r["contributions"] == pytest.approx(list(want), abs=1e-9)
        assert r["base_value"] == pytest.approx(sum(conditional(nodes, t, x, set()) for t in trees))
        assert r["base_value"] + sum(r["contributions"]) == pytest.approx(margin_of(nodes, x))


def shap_frame(spark):
    return spark.createDataFrame([(1, 0.5, [0.1, -0.4, 0.2, 0.0]), (2, 0.5, [0.3, 0.0, -0.2, 0.1])], "id BIGINT, base_value DOUBLE, contributions ARRAY<DOUBLE>")


def test_waterfall(spark):
    got = explain.waterfall(shap_frame(spark), 1, list("abcd"), 3).orderBy("pos").collect()
    assert [r["feature"] for r in got] == ["b", "c", "2 other features"]
    assert got[0]["stop"] == pytest.approx(0.4) and got[-1]["start"] == pytest.approx(0.5)
    for upper, lower in zip(got, got[1:]):
        assert upper["start"] == pytest.approx(lower["stop"])
    assert explain.waterfall(shap_frame(spark), 1, list("abcd"), 10).count() == 4


def test_importance_and_ranks(spark):
    top = explain.shap_importance(shap_frame(spark), list("abcd"), 3).collect()
    assert [r["feature"] for r in top] == ["a", "b", "c"] and top[0]["importance"] == pytest.approx(0.2)
    a = spark.createDataFrame([("x", 3.0), ("y", 2.0)], "feature STRING, importance DOUBLE")
    b = spark.createDataFrame([("x", 1.0), ("z", 2.0)], "feature STRING, importance DOUBLE")
    got = {r["feature"]: tuple(r)[1:] for r in explain.rank_compare(a, b).collect()}
    assert got == {"x": (1, 2, -1), "y": (2, None, None), "z": (None, 1, None)}


def test_explain_row(parts, boosted):
    test = parts[1]
    one = test.agg(F.min(KEY)).first()[0]
    got = explain.explain_row(explain.tree_shap(boosted, test, KEY), test, one, FEATURES, KEY, LABEL).toPandas()
    assert got.feature.tolist() == FEATURES and got.margin.nunique() == 1
    assert got.base_value.iloc[0] + got.contribution.sum() == pytest.approx(got.margin.iloc[0])
    want = models.score(boosted, test.filter(F.col(KEY) == one), KEY).first()
    assert got.pred.iloc[0] == want["pred"] and got.actual.iloc[0] == want["label"]
    gains = explain.gain_importance(boosted, 15)
    assert gains.count() == 15 and gains.first()["importance"] > 0


def test_train_evaluate_leaves_the_model_alone(parts):
    train, test = parts
    spec = training.Spec("Normal Sampling", {"max_depth": 2, "learning_rate": 0.1})
    out = training.train_evaluate(spec, train, test, FEATURES, LABEL, KEY, rounds=2, folds=2)
    again = models.score(out.model, test, KEY).select("id", "score")
    assert out.scored.filter("split = 'test'").select("id", "score").exceptAll(again).count() == 0
    assert {r["split"] for r in out.metrics.collect()} == {"train", "test"}
    assert out.cv.first()["folds"] == 2 and out.confusion.agg(F.sum("n")).first()[0] == test.count()


def test_sweep_with_balancing_and_tracking(spark, parts):
    train, test = parts
    small = {n: {**p, "max_depth": 2} for n, p in models.TUNED.items()}
    specs = training.strategies(LABEL, KEY, FEATURES, small)
    outcomes, table = training.strategy_sweep(train, test, specs, FEATURES, LABEL, KEY, rounds=1)
    assert table.count() == 6 and [o.name for o in outcomes] == list(models.TUNED)
    for o in outcomes[1:]:
        n = o.scored.filter("split = 'train'").groupBy("label").count().toPandas()["count"]
        assert n.nunique() == 1  # balanced
    store = tracking.RunStore(spark, work_path(spark, "runs"))
    for o in outcomes:
        store.log_outcome("credit", o.name, o.name, o.model, metrics.run_metrics(o.report))
    assert store.table("runs").count() == 3
    assert store.table("run_params").filter("key = 'sampling_strategy'").count() == 3
    assert store.table("models").filter("size_bytes > 0").count() == 3
    got = {r["run"]: r for r in store.compare("Normal Sampling").collect()}
    assert got["Normal Sampling"]["accuracy_delta"] == 0 and len(got) == 3
    want = metrics.run_metrics(outcomes[1].report).first()
    assert got["Manual Oversampling"]["recall_default"] == pytest.approx(want["recall_default"])
    assert tracking.artifact_name("gbt", "Manual Oversampling") == "gbt_manual_oversampling"


def test_balance_before_split_is_available(parts):
    train, test = parts
    spec = training.Spec("o", {"max_depth": 2}, training.balanced("oversample", LABEL, KEY, FEATURES))
    out = training.train_evaluate(spec, train, test, FEATURES, LABEL, KEY, rounds=1, folds=2, balance_before_split=True)
    assert out.cv.first()["folds"] == 2
