"""The booster against exact greedy trees on raw values, and its two ways of growing against each other."""

import numpy as np
import pandas as pd
import pytest
from pyspark import RDD
from pyspark.sql import functions as F

from scorepipe.operators import boosting, models

COLS = list("abcde")


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({c: rng.normal(size=1500) for c in COLS})
    pdf["b"] = rng.integers(0, 7, 1500)
    pdf["c"] = pdf.c.round(1)
    pdf["d"] = rng.choice(200, 1500) / 7
    pdf["a"], pdf["e"] = pdf.a.round(1), pdf.e.round(1)
    odds = 1.5 * (pdf.a > 0.3) - 2 * ((pdf.b > 3) & (pdf.c < 0)) + 0.05 * pdf.d - 1
    pdf["y"] = (rng.random(1500) < 1 / (1 + np.exp(-odds))).astype(int)
    pdf["id"], pdf["fold"] = range(1500), rng.integers(0, 3, 1500)
    return pdf


def greedy(x, y, s):
    """Margins by growing every tree on sorted raw values; the gain is summed row by row."""
    margin, sizes = np.zeros(len(y)), []
    for t in range(s.rounds):
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y > 0, s.positive, 1.0)
        g, h = (p - y) * w, p * (1 - p) * w
        cols = s.features(t, x.shape[1])
        out, nodes = np.zeros(len(y)), 0

        def grow(rows, level):
            nonlocal nodes
            nodes += 1
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (max(1e-6, s.gamma), None)
            if level < s.depth:
                for f in cols:
                    v = x[rows, f]
                    for cut in np.unique(v)[:-1]:
                        left = v <= cut
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        if min(hl, hs - hl) < s.min_child:
                            continue
                        gain = gl**2 / (hl + s.penalty) + (gs - gl) ** 2 / (hs - hl + s.penalty) - gs**2 / (hs + s.penalty)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, cut))
            if best[1] is None:
                out[rows] = -gs / (hs + s.penalty)
                return
            left = x[rows, best[1][0]] <= best[1][1]
            grow(rows[left], level + 1)
            grow(rows[~left], level + 1)

        grow(np.arange(len(y)), 0)
        sizes.append(nodes)
        margin += s.rate * out
    return margin, sizes


@pytest.mark.parametrize("params", [
    {"max_depth": 3, "learning_rate": 0.3, "scale_pos_weight": 3, "gamma": 0.5, "min_child_weight": 5},
    {"max_depth": 6, "learning_rate": 0.1, "colsample_bytree": 0.5, "gamma": 1.5},
])
def test_trees_are_those_of_exact_greedy_search(spark, table, params):
    model = boosting.fit(spark.createDataFrame(table), COLS, "y", params, rounds=4)
    want, sizes = greedy(table[COLS].to_numpy(), table.y.to_numpy(), boosting.Settings.of(params, 4))
    assert [t.numNodes for t in model.trees] == sizes and max(sizes) > 7
    assert np.allclose(model.margins(table[COLS].to_numpy(float)), want, atol=1e-5)
    scored = model.transform(spark.createDataFrame(table)).select("id", "score").toPandas().set_index("id")["score"].sort_index()
    assert np.allclose(scored, 1 / (1 + np.exp(-want)), atol=1e-5)


def test_blocks_and_levels_give_the_same_trees(spark, table, monkeypatch):
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    settings = [
        boosting.Settings(depth=3, rounds=10, rate=0.2, columns=0.6, positive=2, min_child=3), boosting.Settings(depth=4, rounds=3, fold=1),
    ]
    one, one_trees = boosting.fit_many(boosting.binned(df, COLS, "y", cuts, "fold"), settings, len(COLS))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 400)
    monkeypatch.setattr(boosting, "CELLS", 3000)
    blocks = boosting.binned(df.repartition(5), COLS, "y", cuts, "fold")
    assert blocks.count() > 2
    many, many_trees = boosting.fit_many(blocks, settings, len(COLS))
    for a, b in zip(one_trees, many_trees):
        assert len(a) == len(b) and all(np.array_equal(getattr(p, k), getattr(q, k)) for p, q in zip(a, b) for k in ("feature", "bin", "left", "value", "gain"))
    scores = [sorted((r["label"], r["score"]) for r in boosting.left_out_scores(m, settings).filter("model = 1").collect()) for m in (one, many)]
    assert scores[0] == scores[1] and len(scores[0]) == (table.fold == 1).sum()


@pytest.mark.parametrize("message_cells", [1 << 18, 2600])
def test_tables_beyond_a_task_give_the_same_trees(spark, table, monkeypatch, message_cells):
    """One stage a level, in several groups of models, and by shuffles; large levels that keep no sums do as well."""
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    settings = [boosting.Settings(depth=d, rounds=2, columns=0.8, min_child=m, gamma=0.1, fold=f) for d, m, f in ((4, 1, 0), (2, 0, 2), (3, 4, -1))]
    blocks = boosting.binned(df, COLS, "y", cuts, "fold")
    one, one_trees = boosting.fit_many(blocks, settings, len(COLS))
    monkeypatch.setattr(boosting, "DENSE_CELLS", 300)
    few, few_trees = boosting.fit_many(blocks, settings, len(COLS))
    for name, value in (("BLOCK_ROWS", 400), ("CELLS", 3000), ("TASK_BLOCKS", 1), ("MESSAGE_CELLS", message_cells)):
        monkeypatch.setattr(boosting, name, value)
    many, many_trees = boosting.fit_many(boosting.binned(df.repartition(5), COLS, "y", cuts, "fold"), settings, len(COLS), left_out=True)
    for other in (few_trees, many_trees):
        for a, b in zip(one_trees, other):
            assert len(a) == len(b) == 2 and all(np.array_equal(getattr(p, k), getattr(q, k)) for p, q in zip(a, b) for k in ("feature", "bin", "left", "value", "gain", "hess"))
    found = [sorted(map(tuple, boosting.left_out_scores(m, settings).collect())) for m in (one, many)]
    assert found[0] == found[1] and len(found[0]) == table.fold.isin([0, 2]).sum()


def test_a_level_is_one_stage(spark, table, monkeypatch):
    """Levels of a table that no task holds whole neither shuffle nor sort."""
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    for name, value in (("BLOCK_ROWS", 400), ("CELLS", 3000)):
        monkeypatch.setattr(boosting, name, value)
    blocks = boosting.binned(df.repartition(5), COLS, "y", cuts)
    sc = spark.sparkContext
    sc.setJobGroup("levels", "")
    _, trees = boosting.fit_many(blocks, [boosting.Settings(depth=4, rounds=6)], len(COLS))
    sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("levels")]
    tasks = [sc.statusTracker().getStageInfo(s) for j in jobs for s in j.stageIds]
    assert len(trees[0]) == 6 and sum(s is not None and s.numCompletedTasks > 0 for s in tasks) <= 6 * 4 + 10


@pytest.mark.parametrize("part_rows", [1500, 60])
def test_a_deep_tree_is_shuffled_once(spark, table, monkeypatch, part_rows):
    """Levels of wide nodes are stages without a shuffle; what is below the others grows in one step, to the same trees."""
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    settings = [boosting.Settings(depth=9, rounds=4, columns=0.8, gamma=0.1, min_child=m, fold=f) for m, f in ((1, 1), (0.5, -1))]
    _, one = boosting.fit_many(boosting.binned(df, COLS, "y", cuts, "fold"), settings, len(COLS))
    for name, value in (("BLOCK_ROWS", 400), ("CELLS", 3000), ("MESSAGE_CELLS", 5000)):
        monkeypatch.setattr(boosting, name, value)
    monkeypatch.setattr(boosting, "PART_ROWS", part_rows, raising=False)
    blocks = boosting.binned(df.repartition(5), COLS, "y", cuts, "fold")
    sc = spark.sparkContext
    sc.setJobGroup("parts", "")
    _, many = boosting.fit_many(blocks, settings, len(COLS))
    sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup("parts")]
    stages = [sc.statusTracker().getStageInfo(s) for j in jobs for s in j.stageIds]
    done = sum(s is not None and s.numCompletedTasks > 0 for s in stages)
    assert max(len(t.feature) for m in one for t in m) > 40
    for a, b in zip(one, many):
        assert len(a) == len(b) == 4 and all(np.array_equal(getattr(p, k), getattr(q, k)) for p, q in zip(a, b) for k in ("feature", "bin", "left", "right", "value", "gain", "hess"))
    assert part_rows < 1500 or done <= 4 * 3 + 12


def test_margins_are_not_kept_anew_for_every_tree(spark, table, monkeypatch):
    """Keeping them copies the blocks, too; and every core has as many rows."""
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    for name, value in (("BLOCK_ROWS", 400), ("CELLS", 3000)):
        monkeypatch.setattr(boosting, name, value)
    blocks = boosting.binned(df.repartition(5), COLS, "y", cuts)
    sizes = [r["n"] for r in blocks.collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= 8
    kept, persist = [], RDD.persist
    monkeypatch.setattr(RDD, "persist", lambda rdd, *a: kept.append(rdd) or persist(rdd, *a))
    _, trees = boosting.fit_many(blocks, [boosting.Settings(depth=3, rounds=10)], len(COLS))
    assert len(trees[0]) == 10 and len(kept) <= 2


@pytest.mark.parametrize("splits", [1, 9, 64, 150])
def test_leaves_are_those_of_single_steps(splits):
    rng = np.random.default_rng(splits)
    bins, tree = rng.integers(0, 256, (4, 3000)).astype(np.uint8), boosting.Tree()
    open_ = [(0, 0)]
    for _ in range(splits):
        node, level = open_.pop(int(rng.integers(len(open_))))
        open_ += [(c, level + 1) for c in tree.split(node, int(rng.integers(4)), int(rng.integers(255)), 1.0, (0.0, 1.0, 0.0, 1.0))]
    for depth in (0, 1, 2, 5, max(level for _, level in open_)):
        node = np.zeros(3000, np.int32)
        for _ in range(depth):
            tree.step(bins, node)
        assert np.array_equal(tree.leaves(bins, depth), node)


def test_shared_folds_are_separate_fits(spark, table):
    df = spark.createDataFrame(table)
    draws = [{"max_depth": 3}, {"max_depth": 2, "learning_rate": 0.1}]
    got = {(r["draw"], r["fold"]): r["score"] for r in models.cross_validate_boosted(df, COLS, "y", draws, "score_auc", 3, 5).collect()}
    assert set(got) == {(d, f) for d in range(2) for f in range(3)}
    train, test = table[table.fold != 1], table[table.fold == 1]
    cuts = boosting.fit_cuts(df, COLS)
    blocks = boosting.binned(spark.createDataFrame(train), COLS, "y", cuts)
    settings = boosting.Settings.of(draws[0], 5)
    _, trees = boosting.fit_many(blocks, [settings], len(COLS))
    margin = boosting.Ensemble.of(trees[0], cuts, settings.rate, COLS).margins(test[COLS].to_numpy(float))
    pairs = np.sign(margin[test.y == 1][:, None] - margin[test.y == 0][None])
    assert got[0, 1] == pytest.approx((pairs.mean() + 1) / 2)


def test_halving_keeps_the_best(spark, table):
    df = spark.createDataFrame(table)
    space = {"max_depth": [1, 2, 3], "learning_rate": [0.05, 0.1, 0.3]}
    found = models.random_search(df, COLS, "y", "id", space, n=9, k=3, rounds=9, halving=3).toPandas()
    assert sorted(found["rounds"]) == [1] * 6 + [3] * 2 + [9] and found.best.sum() == 1
    assert found.loc[found.best, "rounds"].iloc[0] == 9 and (found.folds == 3).all()


def test_many_values_get_quantile_bins(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"), (F.col("id") % 3).alias("z"), F.lit(5).alias("same"))
    cuts = boosting.fit_cuts(df.repartition(4), ["x", "z", "same"])
    assert 200 <= len(cuts[0]) <= 255 and np.abs(np.diff(cuts[0]) - 20_000 / 256).max() < 10
    assert cuts[1].tolist() == [0, 1] and len(cuts[2]) == 0


def test_missing_values_and_saved_models(spark, table, tmp_path):
    df = spark.createDataFrame(table)
    with pytest.raises(ValueError):
        boosting.fit(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), COLS, "y", {}, 1)
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), COLS, "y", {}, 1)
    fitted = models.fit_gbt(df, COLS, "y", {"max_depth": 2}, rounds=2)
    again = models.Fitted.load(spark, "gbt", fitted.save(str(tmp_path / "m")), COLS, "y", {})
    gone = df.withColumn("a", F.when(F.col("id") > 3, F.col("a")))
    a, b = (models.score(m, gone, "id").toPandas().set_index("id").sort_index() for m in (fitted, again))
    assert a.equals(b) and a.score.isna().sum() == 4 == a.pred.isna().sum()


def test_settings_have_booster_defaults():
    s = boosting.Settings.of(models.TUNED["Normal Sampling"], 7)
    assert (s.depth, s.rate, s.min_child, s.rounds, s.columns, s.gamma, s.positive, s.penalty) == (4, 0.1, 5, 7, 0.4, 0.2, 3, 1.0)
    assert boosting.Settings.of({}) == boosting.Settings(6, 0.3, 0.0, 1.0, 1.0, 1.0)
    assert len(s.features(3, 29)) == 11 and (s.features(3, 29) == s.features(3, 29)).all() and (s.features(3, 29) != s.features(4, 29)).any()


def test_every_level_reads_small_blocks_as_they_are_kept(spark, table, monkeypatch):
    """Serialised blocks go through Java's streams at every level; labels and folds take a byte each, and margins come out as before."""
    df = spark.createDataFrame(table)
    cuts = boosting.fit_cuts(df, COLS)
    blocks = boosting.binned(df, COLS, "y", cuts, "fold")
    settings = [boosting.Settings(depth=3, rounds=7, rate=0.2, fold=f) for f in (0, 1, -1)]
    one, one_trees = boosting.fit_many(blocks, settings, len(COLS))
    monkeypatch.setattr(boosting, "CELLS", 3000)
    kept, persist = [], RDD.persist
    monkeypatch.setattr(RDD, "persist", lambda rdd, level: kept.append((level.deserialized, level.useDisk)) or persist(rdd, level))
    many, many_trees = boosting.fit_many(blocks, settings, len(COLS))
    assert kept and all(k == (True, True) for k in kept)
    assert [[t.value.tolist() for t in m] for m in one_trees] == [[t.value.tolist() for t in m] for m in many_trees]
    a, b = (sorted((r["model"], r["fold"], r["label"], r["score"]) for r in boosting.left_out_scores(m, settings).collect()) for m in (one, many))
    assert a == b and len(a) == table.fold.isin([0, 1]).sum()
    assert boosting._narrow(np.array([0, 1], np.int32)).dtype == np.uint8 and boosting._narrow(np.array([-1, 300], np.int32)).tolist() == [-1, 300]


def test_sums_of_all_rows_need_no_list_of_them():
    rng = np.random.default_rng(4)
    bins, features, widths = rng.integers(0, 7, (3, 500)).astype(np.uint8), np.array([0, 2]), np.full(3, 7)
    g, h, train = rng.integers(-9, 9, 500).astype(float), rng.integers(1, 9, 500).astype(float), rng.random(500) < 0.8
    rows = np.flatnonzero(train)
    some = boosting.node_sums(bins, features, widths, rows, np.zeros(len(rows), np.int64), 1, g[rows], h[rows])
    assert np.array_equal(some, boosting.node_sums(bins, features, widths, None, None, 1, g * train, h * train))


@pytest.mark.parametrize("slab, dense", [(1 << 16, 1 << 20), (900, 1 << 20), (900, 300)])
def test_a_task_with_all_rows_grows_whole_levels(monkeypatch, slab, dense):
    """No step goes node by node, whatever the size of the slabs; the trees are those of the sums of all levels."""
    rng = np.random.default_rng(5)
    bins = np.stack([rng.integers(0, w, 3000) for w in (200, 2, 9, 100)]).astype(np.uint8)
    label, fold = (rng.random(3000) < 0.2 + 0.5 * (bins[0] > 90) * (bins[1] == 1)).astype(np.int32), rng.integers(0, 3, 3000).astype(np.int32)
    for settings in (boosting.Settings(depth=12, rounds=2, fold=1, positive=3), boosting.Settings(depth=4, rounds=2, columns=0.5, min_child=0, gamma=0.2)):
        train, widths, margin, want = fold != settings.fold, bins.max(axis=1).astype(np.int64) + 1, np.zeros(3000), []
        plan = boosting.planned(settings, widths)
        ask = next(plan)
        while ask:
            g, h = boosting.gradients(margin, label, settings.positive)
            rows, slots = ask.rows(ask.tree.leaves(bins, ask.level), train)
            tree, sums = ask.tree, boosting.node_sums(bins, ask.features, widths, rows, slots, len(ask.nodes), g[rows], h[rows])
            try:
                ask = plan.send(sums)
            except StopIteration as end:
                ask, want = None, end.value
            if tree.value is not None:
                margin += settings.rate * tree.value[tree.leaves(bins, settings.depth)]
        calls = []
        with monkeypatch.context() as m:
            m.setattr(boosting, "SLAB_CELLS", slab, raising=False)
            m.setattr(boosting, "DENSE_CELLS", dense)
            m.setattr(boosting.Tree, "split", lambda *_: calls.append(1) or [0, 0])
            got_margin, got = boosting.fit_block(bins, label, fold, settings)
        assert not calls and np.array_equal(got_margin, margin)
        assert all(np.array_equal(getattr(a, k), getattr(b, k)) for a, b in zip(got, want, strict=True) for k in ("feature", "bin", "left", "right", "value", "gain", "hess"))
