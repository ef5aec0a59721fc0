"""Fitted bins, monotone evidence and isotonic steps against brute force."""

import math

import numpy as np
import pandas as pd
import pytest

from scorepipe.operators import binning, isotonic, risk


def minimax(n, pos):
    """Isotonic values by their formula: the largest, over starts, of the least mean up to an end."""
    n, pos = np.asarray(n, float), np.asarray(pos, float)
    cn, cp = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(pos))
    k = len(n)
    return np.array([max(min((cp[b + 1] - cp[a]) / (cn[b + 1] - cn[a]) for b in range(i, k)) for a in range(i + 1)) for i in range(k)])


def test_pooling_is_the_isotonic_fit():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 30):
        for _ in range(20):
            n = rng.integers(1, 6, k)
            pos = rng.binomial(n, np.linspace(0.1, 0.9, k))
            got = np.concatenate([np.full(b - a, pos[a:b].sum() / n[a:b].sum()) for a, b in isotonic.pooled(n.tolist(), pos.tolist())])
            assert np.allclose(got, minimax(n, pos))
            assert all(x < y for x, y in zip(sorted(set(got)), sorted(set(got))[1:]))


@pytest.mark.parametrize("shape", ["noisy", "falling", "rising", "one"])
def test_ranges_are_stitched(spark, shape):
    rng = np.random.default_rng(2)
    score = rng.integers(0, 120, 900) / 7.0 if shape != "one" else np.full(50, 3.0)
    chance = {"noisy": 0.2 + 0.5 * score / 18, "falling": 0.9 - 0.8 * score / 18, "rising": (score > 9).astype(float), "one": np.full(len(score), 0.4)}[shape]
    y = (rng.random(len(score)) < chance).astype(int)
    df = spark.createDataFrame([*((float(s), int(v)) for s, v in zip(score, y)), (None, 1), (math.nan, 1), (4.0, None)], "s DOUBLE, y INT").repartition(4)
    blocks = isotonic.isotonic_blocks(df, "y", "s", buckets=9).orderBy("lo").collect()
    table = pd.DataFrame({"s": score, "y": y}).groupby("s").y.agg(["size", "sum"])
    want = pd.Series(minimax(table["size"], table["sum"]), table.index)
    got = {s: next(r["value"] for r in blocks if r["lo"] <= s <= r["hi"]) for s in table.index}
    assert np.allclose([got[s] for s in table.index], want)
    assert sum(r["n"] for r in blocks) == len(score) and sum(r["pos"] for r in blocks) == y.sum()
    values = [r["value"] for r in blocks]
    assert values == sorted(set(values))


def test_calibrated_scores_follow_the_steps(spark):
    steps = spark.createDataFrame([(1.0, 2.0, 10, 1, 0.1), (3.0, 5.0, 10, 5, 0.5), (6.0, 6.0, 10, 9, 0.9)], "lo DOUBLE, hi DOUBLE, n BIGINT, pos BIGINT, value DOUBLE")
    rows = [(0.0, 0.1), (1.0, 0.1), (2.5, 0.1), (3.0, 0.5), (5.9, 0.5), (6.0, 0.9), (99.0, 0.9), (None, None), (math.nan, None), (3.0, 0.5)]
    df = spark.createDataFrame([(i, s, "x") for i, (s, _) in enumerate(rows)], "id INT, s DOUBLE, value STRING")
    got = {r["id"]: r["calibrated"] for r in isotonic.calibrated(df, steps, "s").collect()}
    assert got == {i: v for i, (_, v) in enumerate(rows)}
    assert {r["calibrated"] for r in isotonic.calibrated(df, steps.limit(0), "s").collect()} == {None}


def test_bins_have_open_ends_and_a_place_for_missing_values(spark):
    base = spark.createDataFrame([(float(i % 50), i % 3) for i in range(1000)] + [(None, 1)], "x DOUBLE, same INT")
    table = binning.fit_bins(base, ["x", "same"], 5)
    cuts = binning.cut_points(table)
    assert cuts["x"] == pytest.approx(np.unique(np.quantile([i % 50 for i in range(1000)], [0.2, 0.4, 0.6, 0.8]))) and len(cuts["same"]) <= 3
    other = spark.createDataFrame([(-100.0, 0), (1e9, 99), (math.nan, None), (None, -5), (cuts["x"][0], 1)], "x DOUBLE, same INT")
    bins = [tuple(r) for r in binning.with_bins(other, table).select("x_bin", "same_bin").collect()]
    assert [b[0] for b in bins] == [0, 4, -1, -1, 0] and bins[2][1] == -1 and bins[3][1] == 0
    psi = binning.stability_by_bins(base, other, table).toPandas()
    assert psi.groupby("column").actual.sum().between(1, 1.001).all() and (psi.psi >= 0).all()
    assert binning.stability_by_bins(base, base, table).toPandas().psi.abs().max() == 0
    empty = binning.fit_bins(base.limit(0), ["x"], 5)
    assert binning.cut_points(empty) == {"x": []}


def test_scores_outside_the_unit_interval_stay_in_bins(spark):
    df = spark.createDataFrame([(-0.2, 1), (0.05, 0), (1.7, 1), (math.nan, 1), (None, 0)], "score DOUBLE, label INT")
    assert {r["bin"]: r["n"] for r in risk.reliability(df, "label", "score").collect()} == {0: 2, 9: 1}
    assert risk.stability(df, df, "score").toPandas().expected.sum() == pytest.approx(1, abs=1e-2)


def test_monotone_parts(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(1.2 * x))).astype(int)
    rows = [(None if i % 40 == 0 else float(a), int(b)) for i, (a, b) in enumerate(zip(x, y))] + [(1.0, None)]
    df = spark.createDataFrame(rows, "x DOUBLE, y INT")
    table = binning.fit_bins(df, ["x"], 20)
    parts = binning.evidence_by_bins(df, "y", table).toPandas()
    own = parts[parts.part >= 0].sort_values("part")
    rates = (own.n_pos / (own.n_pos + own.n_neg)).tolist()
    assert rates == sorted(rates, reverse=True) and 2 < len(own) <= 20
    assert own.lo.iloc[0] == -math.inf and own.hi.iloc[-1] == math.inf and own.hi.tolist()[:-1] == own.lo.tolist()[1:]
    assert parts[parts.part == -1][["n_pos", "n_neg"]].to_numpy().sum() == 100
    plain = binning.evidence_by_bins(df, "y", table, monotone=False).toPandas()
    counts = plain[plain.part >= 0].sort_values("part")
    n, pos = (counts.n_pos + counts.n_neg).to_numpy()[::-1], counts.n_pos.to_numpy()[::-1]
    assert sorted(set(minimax(n, pos).round(12))) == pytest.approx(sorted(set(np.round(rates, 12))))
    iv = binning.information_values(binning.evidence_by_bins(df, "y", table)).first()
    assert iv["iv"] == pytest.approx(parts.iv.sum()) and iv["iv"] > 0.8 and iv["parts"] == len(parts)
