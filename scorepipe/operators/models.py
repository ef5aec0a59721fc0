"""Fitting and scoring: logistic regression by MLlib, boosted trees by `boosting`; cross-validation and random search."""

from __future__ import annotations

import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted
from scorepipe.operators import boosting
from scorepipe.operators.encode import fit_scaler
from scorepipe.operators.metrics import accuracy, label_auc, predict_label, rank_metrics
from scorepipe.operators.profile import cv_summary
from scorepipe.operators.sampling import fold_frames
from scorepipe.sources.tables import dealt, materialise

# The tuned settings of the three balancing strategies.
TUNED = {
    "Normal Sampling": {
        "min_child_weight": 5, "max_depth": 4, "learning_rate": 0.1, "gamma": 0.2,
        "colsample_bytree": 0.4, "scale_pos_weight": 3,
    },
    "Manual Oversampling": {
        "min_child_weight": 1, "max_depth": 15, "learning_rate": 0.2, "gamma": 0.1, "colsample_bytree": 0.4,
    },
    "SMOTE": {
        "min_child_weight": 1, "max_depth": 15, "learning_rate": 0.05, "gamma": 0.4, "colsample_bytree": 0.4,
    },
}
LOGISTIC = {"max_iter": 1000, "solver": "lbfgs", "C": 1}

# The grid that random search draws from.
SEARCH_SPACE = {
    "learning_rate": [0.05, 0.1, 0.15, 0.2, 0.25, 0.3],
    "max_depth": [3, 4, 5, 6, 8, 10, 12, 15],
    "min_child_weight": [1, 3, 5, 7],
    "gamma": [0.0, 0.1, 0.2, 0.3, 0.4],
    "colsample_bytree": [0.3, 0.4, 0.5, 0.7],
    "scale_pos_weight": [1, 3, 5, 7],
}


class Fitted:
    """A fitted classifier with its feature list; `score` needs nothing else."""

    def __init__(self, kind: str, model, features: list[str], label: str, params: dict):
        self.kind, self.model, self.features, self.label, self.params = kind, model, features, label, params

    @property
    def core(self):
        return self.model if self.kind == "gbt" else self.model.stages[-1]

    def save(self, path: str) -> str:
        if self.kind == "gbt":
            self.model.save(path, SparkSession.active())
        else:
            self.model.write().overwrite().save(path)
        return path

    @staticmethod
    def load(spark: SparkSession, kind: str, path: str, features: list[str], label: str, params: dict) -> Fitted:
        """A saved model; a logistic one holds the scaling of its inputs."""
        model = boosting.Ensemble.load(spark, path, features) if kind == "gbt" else PipelineModel.load(path)
        return Fitted(kind, model, features, label, params)


def _assembled(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def _inputs(features: list[str], stats: dict[str, tuple[float, float]] | None) -> tuple[list, VectorAssembler]:
    """Stages before the learner: the scaling when there is one, and the assembler."""
    if not stats:
        return [], _assembled(features)

    def scaled(i, c):
        mean, std = stats[c]
        name = "`" + c.replace("`", "``") + "`"
        return f"(CAST({name} AS DOUBLE) - {float(mean or 0.0)!r}D) / {float(std or 1.0)!r}D AS _scaled_{i}"

    columns = ", ".join(scaled(i, c) for i, c in enumerate(features))
    return [SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")], _assembled([f"_scaled_{i}" for i in range(len(features))])


def fit_logistic(
    df: DataFrame, features: list[str], label: str, c: float = 1.0, max_iter: int = 1000,
    tol: float = 1e-6, weight: str | None = None, stats: dict[str, tuple[float, float]] | None = None,
) -> Fitted:
    """L2 logistic regression with inverse strength C, intercept not penalised.

    Features go in as given, or standardised by ``stats`` (mean, deviation); the scaling is a stage of the
    model, so a saved one scores raw rows.

    MLlib averages the loss over rows, so the penalty that corresponds to C is 1 / (C * total weight).
    """
    total = df.agg(F.sum(quoted(weight)) if weight else F.count(F.lit(1))).first()[0]
    if not total:
        raise ValueError("no rows to fit")
    lr = LogisticRegression(
        featuresCol="features", labelCol=label, regParam=1.0 / (c * float(total)), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=tol, family="binomial",
    )
    if weight:
        lr = lr.setWeightCol(weight)
    before, va = _inputs(features, stats)
    rows = va.transform(reduce(lambda d, stage: stage.transform(d), before, dealt(df, [*features, label])))
    model = PipelineModel([*before, va, lr.fit(rows)])
    return Fitted("logistic", model, features, label, {"C": c, "max_iter": max_iter, "solver": "lbfgs"})


def coefficients(fitted: Fitted) -> DataFrame:
    """(feature, weight) of a logistic model, the intercept under its own name."""
    rows = [("intercept", float(fitted.core.intercept))]
    rows += [(f, float(w)) for f, w in zip(fitted.features, fitted.core.coefficients.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature STRING, weight DOUBLE")


def fit_gbt(
    df: DataFrame, features: list[str], label: str, params: dict, rounds: int = 100, seed: int = 100
) -> Fitted:
    """Boosted trees; settings that are not named keep the booster's defaults (see `boosting.Settings`)."""
    model = boosting.fit(df, features, label, params, rounds, seed)
    return Fitted("gbt", model, features, label, {**params, "rounds": rounds})


def score(fitted: Fitted, df: DataFrame, key: str, keep: list[str] = (), threshold: float = 0.5) -> DataFrame:
    """(id, keep..., label, score, pred): probability of the positive class and the hard label."""
    names = [quoted(key).alias("id"), *[quoted(c) for c in keep], quoted(fitted.label).cast("int").alias("label")]
    if fitted.kind == "gbt":
        out = fitted.model.transform(df, "_score").select(*names, F.col("_score").alias("score"))
    else:
        out = fitted.model.transform(df).select(*names, F.get(vector_to_array("probability"), F.lit(1)).alias("score"))
    return predict_label(out, "score", threshold)


def score_linear(df: DataFrame, weights: dict[str, float], intercept: float = 0.0, out: str = "score") -> DataFrame:
    """Logistic score from given weights, one expression."""
    margin = reduce(lambda a, b: a + b, [F.lit(float(w)) * quoted(c).cast("double") for c, w in weights.items()], F.lit(float(intercept)))
    return df.withColumn(out, 1.0 / (1.0 + F.exp(-margin)))


Fit = Callable[[DataFrame, list[str], str], Fitted]


def scaled_logistic(train: DataFrame, features: list[str], label: str) -> tuple[Fitted, Callable[[DataFrame], DataFrame]]:
    """Logistic regression on standardised features. The model scales its inputs, so their transform is none."""
    stats = {r["column"]: (r["mean"], r["std_pop"]) for r in fit_scaler(train, features).collect()}
    return fit_logistic(train, features, label, stats=stats), lambda df: df


def cross_validate(
    df: DataFrame, fit: Callable, features: list[str], label: str, key: str, metric: str, k: int = 5,
    balance: Callable[[DataFrame], DataFrame] | None = None, fold: str = "fold", parallelism: int = 5,
) -> DataFrame:
    """(fold, score) with one fit per fold; the frame must carry its fold number.

    `fit(train, features, label)` returns a model, or a model and the transform of its inputs. It
    sees only the fold's training rows, so scaling and `balance` never touch validation rows. To
    balance before folding, fold an already balanced frame. No model given to this function changes.
    """
    def one(i):
        train, valid = fold_frames(df, i, fold)
        train = materialise(balance(train) if balance else train)
        got = fit(train, features, label)
        model, prepare = got if isinstance(got, tuple) else (got, lambda d: d)
        train.unpersist()
        return score(model, prepare(valid), key, [fold])

    with ThreadPoolExecutor(max(1, min(k, parallelism))) as pool:  # small jobs of several fits fill the cluster
        scored = list(pool.map(one, range(k)))
    rows = reduce(lambda a, b: a.unionByName(b), scored)
    return fold_scores(rows, metric, [fold]).select(quoted(fold).alias("fold"), "score")


def fold_scores(rows: DataFrame, metric: str, by: list[str]) -> DataFrame:
    """(by..., score) of scored rows (label, score, pred)."""
    if metric == "accuracy":
        return accuracy(rows, "label", "pred", by).withColumnRenamed("accuracy", "score")
    if metric == "label_auc":
        return label_auc(rows, "label", "pred", by).withColumnRenamed("label_auc", "score")
    if metric == "score_auc":
        return rank_metrics(rows, "label", "score", by).select(*by, F.col("auc").alias("score"))
    raise ValueError(f"unknown metric {metric!r}")


def cross_validate_boosted(
    df: DataFrame, features: list[str], label: str, draws: list[dict], metric: str, k: int = 5, rounds: int = 100, seed: int = 100,
    fold: str = "fold",
) -> DataFrame:
    """(draw, fold, score) of one booster per setting and fold, all fitted over one binned copy of the rows.

    Bins are cut on all rows (they never look at the label); gradients of a model come from the other folds only.
    """
    cuts = boosting.fit_cuts(df, features)
    blocks = boosting.binned(df, features, label, cuts, fold)
    models = [boosting.Settings.of(params, rounds, seed, i) for params in draws for i in range(k)]
    margins, _ = boosting.fit_many(blocks, models, len(features), keep_trees=False, left_out=True)
    rows = predict_label(boosting.left_out_scores(margins, models), "score")
    found = fold_scores(rows, metric, ["model", "fold"])
    return found.select(F.expr(f"CAST(model DIV {k} AS INT)").alias("draw"), "fold", "score")


def random_draws(space: dict[str, list], n: int, seed: int = 100) -> list[dict]:
    """n distinct settings of the grid (all of them when it is smaller), in drawing order."""
    size = reduce(lambda a, b: a * b, [len(v) for v in space.values()], 1)
    picks = random.Random(seed).sample(range(size), min(n, size))
    out = []
    for p in picks:
        choice = {}
        for name, values in space.items():
            p, at = divmod(p, len(values))
            choice[name] = values[at]
        out.append(choice)
    return out


def random_search(
    df: DataFrame, features: list[str], label: str, key: str, space: dict[str, list] = SEARCH_SPACE,
    n: int = 200, k: int = 5, rounds: int = 100, seed: int = 100, fold: str = "fold", halving: int | None = None,
) -> DataFrame:
    """(draw, params, folds, mean, std_pop, rounds, best): cross-validated AUC of n settings from the grid.

    All settings and folds share one binned copy of the rows and are fitted side by side. With ``halving`` only the
    best of every so many settings go on from a first few rounds to more of them; those left behind keep their
    last score and its rounds, and none of them can be best.
    """
    spark = df.sparkSession
    draws = random_draws(space, n, seed)
    found: dict[int, tuple] = {}
    alive, steps = list(range(len(draws))), [rounds]
    while halving and steps[0] >= halving and len(draws) >= halving ** len(steps):
        steps.insert(0, max(1, steps[0] // halving))
    for step in steps:
        scores = cross_validate_boosted(df, features, label, [draws[d] for d in alive], "score_auc", k, step, seed, fold)
        table = scores.groupBy("draw").agg(F.count("score"), F.avg("score"), F.stddev_pop("score")).collect()
        found.update({alive[r[0]]: (*r[1:], step) for r in table})
        if step != rounds:
            alive = sorted(alive, key=lambda d: (-(found[d][1] or 0.0), d))[: -(-len(alive) // halving)]
    top = max(alive, key=lambda d: (found[d][1] is not None, found[d][1] or 0.0, -d))
    rows = [(d, {a: str(b) for a, b in p.items()}, *found[d], d == top) for d, p in enumerate(draws)]
    return spark.createDataFrame(
        rows, "draw INT, params MAP<STRING, STRING>, folds BIGINT, mean DOUBLE, std_pop DOUBLE, rounds INT, best BOOLEAN"
    )
