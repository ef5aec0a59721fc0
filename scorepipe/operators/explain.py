"""Attribution of scores to features."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scorepipe.functions.columns import quoted
from scorepipe.operators.models import Fitted

MAX_LEAF_CELLS = 4_000_000
"""Leaf-table cells per broadcast, about 100 MB; a larger ensemble is applied in several passes."""


def tree_nodes(fitted: Fitted) -> DataFrame:
    """Node table of a boosted ensemble.

    (tree, node, tree_weight, value, cover, gain, left, right, feature, threshold); left = -1 marks a leaf.
    """
    return fitted.core.node_table(SparkSession.active())


def leaf_paths(nodes: DataFrame) -> list[dict]:
    """Leaves with the interval (lo, hi] and the cover share that their path puts on each feature.

    The node table is the size of the model, not of the data; it is read on the driver like any
    other model parameter.
    """
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}
    leaves, todo = [], [(key, {}) for key in rows if key[1] == 0]
    while todo:
        (tree, node), box = todo.pop()
        r = rows[(tree, node)]
        if r["left"] < 0:
            # log-odds are twice the weighted sum of the trees
            leaves.append({"tree": tree, "node": node, "value": 2.0 * r["tree_weight"] * r["value"], "box": box})
            continue
        for child, is_left in ((r["left"], True), (r["right"], False)):
            lo, hi, share = box.get(r["feature"], (-np.inf, np.inf, 1.0))
            lo, hi = (lo, min(hi, r["threshold"])) if is_left else (max(lo, r["threshold"]), hi)
            part = rows[(tree, child)]["cover"] / r["cover"]
            todo.append(((tree, child), {**box, r["feature"]: (lo, hi, share * part)}))
    return sorted(leaves, key=lambda leaf: (leaf["tree"], leaf["node"]))


def base_value(leaves: list[dict]) -> float:
    """Expected log-odds over the training cover."""
    return float(sum(leaf["value"] * np.prod([s for _, _, s in leaf["box"].values()]) for leaf in leaves))


def _leaf_arrays(leaves: list[dict]):
    """Leaves padded to one width; padding has share 1 and always matches, so it receives nothing."""
    width = max(1, max((len(leaf["box"]) for leaf in leaves), default=1))
    feature = np.zeros((len(leaves), width), dtype=int)
    lo, hi = np.full((len(leaves), width), -np.inf), np.full((len(leaves), width), np.inf)
    share = np.ones((len(leaves), width))
    for i, leaf in enumerate(leaves):
        for j, (f, (a, b, s)) in enumerate(sorted(leaf["box"].items())):
            feature[i, j], lo[i, j], hi[i, j], share[i, j] = f, a, b, s
    return np.array([leaf["value"] for leaf in leaves]), feature, lo, hi, share


def leaf_attributions(x: np.ndarray, value, feature, lo, hi, share) -> np.ndarray:
    """Shapley values of a sum of leaves, rows x features.

    For one leaf the Shapley weights are a Beta integral over t in (0, 1) of the product, over the
    other path features, of (matches * t + share * (1 - t)). The integrand is a polynomial in t of degree
    below the path length, so Gauss-Legendre nodes give it exactly.
    """
    t, w = np.polynomial.legendre.leggauss(max(1, (feature.shape[1] + 1) // 2))
    t, w = (t + 1) / 2, w / 2
    out = np.zeros((len(x), x.shape[1]))
    step = max(1, 2_000_000 // (feature.size * len(t)))
    for s in range(0, len(x), step):
        v = x[s:s + step][:, feature]
        match = ((v > lo) & (v <= hi)).astype(float)
        weight = np.zeros_like(match)
        for tq, wq in zip(t, w):
            factor = match * tq + share * (1 - tq)
            weight += wq * factor.prod(axis=2, keepdims=True) / factor
        gain = value[None, :, None] * (match - share) * weight
        for j in range(feature.shape[1]):
            hits = np.zeros((gain.shape[1], x.shape[1]))
            hits[np.arange(gain.shape[1]), feature[:, j]] = 1.0
            out[s:s + step] += gain[:, :, j] @ hits
    return out


def tree_shap(fitted: Fitted, df: DataFrame, key: str, keep: list[str] = ()) -> DataFrame:
    """(id, keep..., base_value, contributions): path-dependent attributions in log-odds.

    base_value plus the contributions is the model's log-odds for the row. The leaf table travels as
    a broadcast of bounded size; rows stay where they are.
    """
    spark = df.sparkSession
    leaves = leaf_paths(tree_nodes(fitted))
    width = max(1, max((len(leaf["box"]) for leaf in leaves), default=1))
    per_pass = max(1, MAX_LEAF_CELLS // width)
    base = base_value(leaves)
    features = fitted.features
    kept = [f.dataType.simpleString() for c in keep for f in df.schema.fields if f.name == c]
    id_type = dict(df.dtypes)[key]
    out = df.select(
        quoted(key).alias("id"), *[quoted(c) for c in keep], F.lit(base).alias("base_value"),
        F.array(*[quoted(c).cast("double") for c in features]).alias("x"),
        F.array_repeat(F.lit(0.0).cast("double"), len(features)).alias("contributions"),
    )
    schema = ", ".join(
        [f"id {id_type}", *[f"`{c}` {t}" for c, t in zip(keep, kept)],
         "base_value DOUBLE", "x ARRAY<DOUBLE>", "contributions ARRAY<DOUBLE>"]
    )
    for s in range(0, len(leaves), per_pass):
        shared = spark.sparkContext.broadcast(_leaf_arrays(leaves[s:s + per_pass]))

        def add(batches, shared=shared):
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf["x"].to_numpy()).astype(float)
                    before = np.stack(pdf["contributions"].to_numpy())
                    pdf["contributions"] = list(before + leaf_attributions(x, *shared.value))
                yield pdf

        out = out.mapInPandas(add, schema)
    return out.drop("x")


def linear_shap(df: DataFrame, weights: dict[str, float], means: dict[str, float], key: str, intercept: float = 0.0) -> DataFrame:
    """(id, base_value, contributions): weight * (x - mean) per feature of a linear score."""
    base = float(intercept) + sum(w * means[c] for c, w in weights.items())
    parts = [F.lit(float(w)) * (quoted(c).cast("double") - F.lit(float(means[c]))) for c, w in weights.items()]
    return df.select(quoted(key).alias("id"), F.lit(base).alias("base_value"), F.array(*parts).alias("contributions"))


def long_contributions(shap: DataFrame, features: list[str]) -> DataFrame:
    """(id, feature, contribution), one row per row and feature."""
    names = F.array(*[F.lit(f) for f in features])
    return shap.select("id", F.inline(F.arrays_zip(names.alias("feature"), F.col("contributions").alias("contribution"))))


def explain_row(shap: DataFrame, rows: DataFrame, row_id: object, features: list[str], key: str, label: str, threshold: float = 0.0) -> DataFrame:
    """(feature, value, contribution, base_value, margin, pred, actual) of one row.

    Both sides are filtered by the key first. The filter cannot pass through `tree_shap`, so give that
    only the row to explain.
    """
    one = shap.filter(F.col("id") == F.lit(row_id))
    margin = F.col("base_value") + F.aggregate("contributions", F.lit(0.0).cast("double"), lambda a, b: a + b)
    own = rows.filter(quoted(key) == F.lit(row_id)).select(
        quoted(key).alias("id"), quoted(label).alias("actual"),
        F.array(*[quoted(c).cast("double") for c in features]).alias("values"),
    )
    cells = F.arrays_zip(
        F.array(*[F.lit(f) for f in features]).alias("feature"), F.col("values").alias("value"),
        F.col("contributions").alias("contribution"),
    )
    both = one.withColumn("margin", margin).join(own, "id")
    return both.select("id", "base_value", "margin", "actual", F.inline(cells)).select(
        "feature", "value", "contribution", "base_value", "margin",
        F.when(F.col("margin") > threshold, 1).otherwise(0).alias("pred"), "actual",
    )


def waterfall(shap: DataFrame, row_id: object, features: list[str], max_display: int = 10) -> DataFrame:
    """(pos, feature, contribution, start, stop) of one row, largest contribution first.

    Shows max_display bars; when there are more features, the last bar sums up the rest. The bars
    lead from the base value (start of the last bar) to the score (stop of the first).
    """
    shown = len(features) if len(features) <= max_display else max_display - 1
    rest = len(features) - shown
    one = shap.filter(F.col("id") == F.lit(row_id))
    cells = long_contributions(one, features)
    order = Window.partitionBy("id").orderBy(F.desc(F.abs("contribution")), "feature")
    ranked = cells.withColumn("rn", F.row_number().over(order))
    lumped = ranked.groupBy(
        "id",
        F.least("rn", F.lit(shown + 1)).alias("pos"),
        F.when(F.col("rn") <= shown, F.col("feature")).otherwise(F.lit(f"{rest} other features")).alias("feature"),
    ).agg(F.sum("contribution").alias("contribution"))
    up = Window.partitionBy("id").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = one.select("id", "base_value")
    return lumped.withColumn("run", F.sum("contribution").over(up)).join(base, "id").select(
        "pos", "feature", "contribution",
        (F.col("base_value") + F.col("run") - F.col("contribution")).alias("start"),
        (F.col("base_value") + F.col("run")).alias("stop"),
    )


def shap_importance(shap: DataFrame, features: list[str], k: int = 15) -> DataFrame:
    """(feature, importance): mean absolute contribution, the k largest. One pass without exploding rows."""
    sums = shap.agg(*[F.avg(F.abs(F.get("contributions", F.lit(i)))).alias(f"a{i}") for i in range(len(features))])
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"a{i}").alias("importance")) for i, f in enumerate(features)]
    return sums.select(F.inline(F.array(*cells))).orderBy(F.desc("importance"), "feature").limit(k)


def gain_importance(fitted: Fitted, k: int = 15) -> DataFrame:
    """(feature, importance): share of the split gain, the k largest."""
    gains = fitted.core.featureImportances.toArray()
    rows = [(f, float(g)) for f, g in zip(fitted.features, gains)]
    frame = SparkSession.active().createDataFrame(rows, "feature STRING, importance DOUBLE")
    return frame.orderBy(F.desc("importance"), "feature").limit(k)


def rank_compare(a: DataFrame, b: DataFrame, a_name: str = "gain", b_name: str = "shap") -> DataFrame:
    """(feature, rank in a, rank in b, shift) over two importance tables (feature, importance).

    The windows run over one row per feature.
    """
    def ranked(t, name):
        order = Window.orderBy(F.desc("importance"))
        return t.select("feature", F.rank().over(order).alias(f"{name}_rank"))

    both = ranked(a, a_name).join(ranked(b, b_name), "feature", "full")
    return both.withColumn("shift", F.col(f"{a_name}_rank") - F.col(f"{b_name}_rank"))
