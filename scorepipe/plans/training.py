"""Train and evaluate one strategy, and sweep over strategies."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted
from scorepipe.operators import metrics
from scorepipe.operators.models import TUNED, Fitted, cross_validate, cross_validate_boosted, fit_gbt, score
from scorepipe.operators.profile import cv_summary
from scorepipe.operators.sampling import kfold, oversample, smote
from scorepipe.sources.tables import materialise


@dataclass
class Spec:
    """A strategy: how the training rows are balanced and the settings of its booster."""

    name: str
    params: dict
    balance: Callable[[DataFrame], DataFrame] | None = None


@dataclass
class Outcome:
    name: str
    model: Fitted
    metrics: DataFrame  # split, accuracy, auc
    report: DataFrame  # class report of the test rows
    confusion: DataFrame
    roc: DataFrame
    discrimination: DataFrame  # auc, gini, ks of the test rows
    cv: DataFrame | None = None
    scored: DataFrame = field(default=None, repr=False)


def balanced(kind: str, label: str, key: str, features: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Balancing step; (key, draw) identifies a row of its result."""

    def step(df: DataFrame) -> DataFrame:
        if kind == "oversample":
            out = oversample(df, label, key)
        elif kind == "smote":
            out = smote(df, label, key, features)
        else:
            raise ValueError(kind)
        return out.select(key, "draw", *features, label)

    return step


def strategies(label: str, key: str, features: list[str], settings: dict[str, dict] = TUNED) -> list[Spec]:
    """The three strategies: class weight, over-sampling, synthetic rows."""
    kinds = {"Normal Sampling": None, "Manual Oversampling": "oversample", "SMOTE": "smote"}
    return [
        Spec(name, settings[name], balanced(kind, label, key, features) if kind else None)
        for name, kind in kinds.items()
    ]


def train_evaluate(
    spec: Spec, train: DataFrame, test: DataFrame, features: list[str], label: str, key: str,
    rounds: int = 100, folds: int = 0, balance_before_split: bool = False,
) -> Outcome:
    """Fit once, score train and test, report. Cross-validation, when asked, fits models of its own.

    With `balance_before_split` the folds are drawn from already balanced rows, so copies of a row
    can fall on both sides; it is there only for comparison. Its folds go by key and draw number,
    since drawn rows share keys and synthetic ones have none.
    """
    def fit(t, f, y):
        return fit_gbt(t, f, y, spec.params, rounds)

    rows = materialise(spec.balance(train) if spec.balance else train)
    model = fit(rows, features, label)
    scored = materialise(
        score(model, rows, key).withColumn("split", F.lit("train"))
        .unionByName(score(model, test, key).withColumn("split", F.lit("test")))
    )
    on_test = scored.filter(F.col("split") == "test")
    cv = None
    if folds:
        if balance_before_split and spec.balance:
            # a drawn row is named by its draw, any other by its key: the two never meet
            own = F.concat(F.lit("key:"), quoted(key).cast("string"))
            numbered = rows.withColumn("_row", F.coalesce(F.concat(F.lit("draw:"), quoted("draw").cast("string")), own))
            cv = cross_validate(kfold(numbered, "_row", folds), fit, features, label, "_row", "label_auc", folds)
        else:
            numbered = materialise(kfold(train, key, folds))
            if spec.balance:
                cv = cross_validate(numbered, fit, features, label, key, "label_auc", folds, balance=spec.balance)
            else:  # all folds over one binned copy
                cv = cross_validate_boosted(numbered, features, label, [spec.params], "label_auc", folds, rounds).drop("draw")
    return Outcome(
        spec.name, model,
        metrics.evaluate(scored), metrics.class_report(on_test, "label", "pred"),
        metrics.confusion(on_test, "label", "pred"), metrics.roc_curve(on_test, "label", "score"),
        metrics.rank_metrics(on_test, "label", "score"), cv_summary(cv) if folds else None, scored,
    )


def strategy_sweep(
    train: DataFrame, test: DataFrame, specs: list[Spec], features: list[str], label: str, key: str, rounds: int = 100,
    folds: int = 0,
) -> tuple[list[Outcome], DataFrame]:
    """Outcomes per strategy, and one frame (strategy, split, accuracy, auc) over all of them."""
    with ThreadPoolExecutor(max(1, len(specs))) as pool:
        outcomes = list(pool.map(lambda s: train_evaluate(s, train, test, features, label, key, rounds, folds), specs))
    table = reduce(
        lambda a, b: a.unionByName(b),
        [o.metrics.select(F.lit(o.name).alias("strategy"), "split", "accuracy", "auc") for o in outcomes],
    )
    return outcomes, table
