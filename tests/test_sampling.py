import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorepipe.operators import neighbors, ordered, sampling
from scorepipe.operators.ordered import dense_index


def labelled(spark, n, pos):
    return spark.range(n).select("id", (F.col("id") < pos).cast("int").alias("y"), (F.col("id") * 1.5).alias("x"))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(3, 200), st.integers(0, 60), st.sampled_from([0.0, 0.1, 0.3, 1.0]))
def test_split_is_exact_and_whole(spark, n, pos, frac):
    pos = min(pos, n)
    got = sampling.stratified_split(labelled(spark, n, pos), "y", "id", frac).toPandas()
    assert len(got) == n and got["id"].is_unique
    for y, size in ((1, pos), (0, n - pos)):
        assert ((got.y == y) & (got.split == "test")).sum() == int(np.floor(frac * size + 0.5))


def test_split_does_not_depend_on_partitioning(spark):
    df = labelled(spark, 500, 100)
    a = sampling.stratified_split(df, "y", "id").orderBy("id").collect()
    b = sampling.stratified_split(df.repartition(7), "y", "id").orderBy("id").collect()
    assert a == b


def test_split_plan_moves_no_rows(spark):
    out = sampling.stratified_split(labelled(spark, 500, 100), "y", "id")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_split_keeps_null_labels(spark):
    df = spark.range(30).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("y"))
    got = sampling.stratified_split(df, "y", "id", 0.5).toPandas()
    assert len(got) == 30 and (got[got.y.isna()].split == "test").sum() == 5


@pytest.mark.parametrize("n, sizes", [(12, [3, 3, 2, 2, 2]), (10, [2] * 5), (3, [1, 1, 1, 0, 0])])
def test_kfold_sizes(spark, n, sizes):
    got = sampling.kfold(spark.range(n), "id").groupBy("fold").count().toPandas().set_index("fold")["count"]
    assert [int(got.get(i, 0)) for i in range(5)] == sizes


def test_stratified_kfold_allocation(spark):
    y = [0, 1, 0, 0, 1, 0, 1, 0, 0, 0, 1, 0, 1]
    df = spark.createDataFrame(list(enumerate(y)), "id BIGINT, y INT")
    got = sampling.stratified_kfold(df, "y", "id", 3).toPandas().sort_values("id")
    laid = sorted(y)  # class 0 appears first
    for c in (0, 1):
        want = [sum(v == c for v in laid[i::3]) for i in range(3)]
        mine = got[got.y == c].fold.tolist()
        assert mine == sorted(mine) and [mine.count(i) for i in range(3)] == want


def test_fold_frames_and_weight(spark):
    df = sampling.kfold(spark.range(20), "id")
    a, b = sampling.fold_frames(df, 2)
    assert a.count() == 16 and b.count() == 4
    w = sampling.class_weight(labelled(spark, 4, 1), "y", 3).orderBy("id").toPandas()["weight"].tolist()
    assert w == [3.0, 1.0, 1.0, 1.0]


def test_cuts_refine_crowded_buckets(spark):
    from scorepipe.functions.keyed import hash_buckets, hash_key
    from scorepipe.operators.ordered import order_cuts

    df = labelled(spark, 3000, 900)
    h = hash_key(1, F.col("id"))
    wants = lambda _, n: [F.lit(0), F.lit(1), F.floor(n / 2), n]
    got = [order_cuts(df, "y", [h, F.col("id")], hash_buckets(h), wants, rank_rows=r) for r in (0, 1, 10**6)]
    coarse = order_cuts(df, "y", [h, F.col("id")], [F.substring(h, 1, 1), *hash_buckets(h)], wants, rank_rows=3)
    assert got[0] == got[1] == got[2] == coarse and got[0][1][0] is None
    ordered = df.filter("y = 1").orderBy(h, "id").select("id").toPandas()["id"].tolist()
    assert [c[1] for c in got[0][1][1:]] == [ordered[0], ordered[449], ordered[899]]


def test_dense_index(spark):
    got = dense_index(spark.range(1000), "id", "s").toPandas()
    assert sorted(got.idx) == list(range(1000)) and got.idx.tolist() != got.id.tolist()


def test_oversample(spark):
    df = labelled(spark, 500, 60)
    got = sampling.oversample(df, "y", "id").toPandas()
    assert (got.y == 0).sum() == (got.y == 1).sum() == 440
    drawn = got[got.y == 1]
    assert drawn.id.between(0, 59).all() and drawn.draw.is_unique and drawn.id.nunique() > 50
    assert sampling.oversample(df, "y", "id", target=7).filter("y = 1").count() == 7
    with pytest.raises(ValueError):
        sampling.oversample(df.filter("y = 1"), "y", "id")


def brute(ids, x, k):
    out = {}
    for i in range(len(ids)):
        d = [(sum((a - b) ** 2 for a, b in zip(x[i], x[j])), ids[j]) for j in range(len(ids)) if j != i]
        out[ids[i]] = sorted(d)[:k]
    return out


@pytest.mark.parametrize("block_rows", [4096, 40, 8])
def test_neighbors_exact_with_hot_copies(spark, block_rows):
    """A third of the rows are copies of one point; values repeat, so distances tie."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(240, 3)), 1)
    x[::3] = x[0]
    ids = rng.permutation(240) + 1000
    df = spark.createDataFrame(pd.DataFrame({"key": ids, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]}))
    got = neighbors.nearest_neighbors(df, "key", ["a", "b", "c"], 4, block_rows, salts=3).toPandas().sort_values(["id", "rank"])
    want = brute(list(ids), x.tolist(), 4)
    assert len(got) == 240 * 4
    for i, g in got.groupby("id"):
        assert g.neighbor.tolist() == [n for _, n in want[i]]
        assert g.dist2.tolist() == pytest.approx([d for d, _ in want[i]])


def test_smote_points_lie_between_neighbours(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(300, 2)) * [1, 50], columns=["a", "b"])
    pdf["n"] = rng.integers(0, 9, 300)
    pdf["id"], pdf["y"] = np.arange(300), (np.arange(300) < 40).astype(int)
    df = spark.createDataFrame(pdf).withColumn("n", F.col("n").cast("int"))
    out = sampling.smote(df, "y", "id", ["a", "b", "n"], block_rows=8)
    assert dict(out.dtypes)["n"] == "int"
    got = out.toPandas()
    assert (got.y == 1).sum() == (got.y == 0).sum() == 260
    plain = sampling.smote(df, "y", "id", ["a", "b", "n"], keep_types=False).toPandas()
    made = plain[plain.draw.notna()][["a", "b", "n"]].to_numpy()
    small = pdf[pdf.y == 1][["a", "b", "n"]].to_numpy(dtype=float)
    near = {i: [j for _, j in v] for i, v in brute(list(range(40)), small.tolist(), 5).items()}
    for p in made:
        assert any(
            np.allclose(np.linalg.norm(p - small[i]) + np.linalg.norm(p - small[j]), np.linalg.norm(small[i] - small[j]), atol=1e-7)
            for i in near for j in near[i]
        )


def test_smote_copies_and_too_few(spark):
    df = spark.range(60).select("id", (F.col("id") < 20).cast("int").alias("y"), F.when(F.col("id") < 18, 1.0).otherwise(F.col("id").cast("double")).alias("a"))
    got = sampling.smote(df, "y", "id", ["a"]).toPandas()
    assert (got.y == 1).sum() == 40
    with pytest.raises(ValueError, match="neighbours"):
        sampling.smote(df.filter("id < 3 OR id >= 20"), "y", "id", ["a"])


def brute_split(rows, frac=0.3, seed=100):
    """Keys of the test part: of each class the first in md5 order."""
    by = {}
    for y, k in rows:
        by.setdefault(y, []).append(k)
    out = set()
    for keys in by.values():
        keys.sort(key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
        out |= set(keys[: math.floor(frac * len(keys) + 0.5)])
    return out


def brute_folds(rows, k=5):
    """Classes laid end to end by their first key; place p of all goes to fold p mod k, each class in key order."""
    by = {}
    for y, key in rows:
        by.setdefault(y, []).append(key)
    out, start = {}, 0
    for y in sorted(by, key=lambda y: min(by[y])):
        held = [sum((start + j) % k == i for j in range(len(by[y]))) for i in range(k)]
        folds = [i for i in range(k) for _ in range(held[i])]
        out.update(zip(sorted(by[y]), folds))
        start += len(by[y])
    return out


@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_more_classes_than_any_literal_and_keys_of_text(spark, monkeypatch, broadcast):
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", broadcast)
    rows = [(f"class {i % 1201}" if i % 1201 else None, f"key {i * 7919 % 100_003:06d}") for i in range(4000)]
    df = spark.createDataFrame(rows, "y STRING, id STRING")
    split = sampling.stratified_split(df, "y", "id").collect()
    assert {r["id"] for r in split if r["split"] == "test"} == brute_split(rows)
    folds = {r["id"]: r["fold"] for r in sampling.stratified_kfold(df, "y", "id").collect()}
    assert folds == brute_folds(rows)


def test_buckets_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(ordered, "OFFSET_ROWS", 4)
    totals = [(g, b, b * b + 1) for g in ("x", None) for b in range(90) if b % 7]
    frame = spark.createDataFrame(totals, "g STRING, b BIGINT, n BIGINT")
    found = {(r["g"], r["b"]): r["n"] for r in ordered.offsets_before(frame, ["g"], "b", ["n"], 4).collect()}  # three levels and more
    assert found == {(g, b): sum(m for h, c, m in totals if h == g and c < b) for g, b, _ in totals}
    index = ordered.dense_index(spark.range(2000), "id", "s", rows_each=3).toPandas()
    plain = ordered.dense_index(spark.range(2000), "id", "s").toPandas()
    assert sorted(index.idx) == list(range(2000)) and index.sort_values("id").idx.tolist() == plain.sort_values("id").idx.tolist()


def test_folds_in_ranges_of_a_few_rows(spark, monkeypatch):
    rows = [(i % 3, i * 31 % 977) for i in range(977)]
    df = spark.createDataFrame(rows, "y INT, id INT")
    real = ordered.range_buckets
    monkeypatch.setattr(sampling, "range_buckets", lambda d, c, out: real(d, c, out, rows_each=50))
    assert {r["id"]: r["fold"] for r in sampling.stratified_kfold(df, "y", "id", 4).collect()} == brute_folds(rows, 4)
