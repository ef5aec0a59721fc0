"""Fitted models at the published settings.

Optimisers have no SQL counterpart. What SQL can say of their results is compared: which rows and folds
they cover, and that values lie where they must (`valid`). The values themselves are checked by tests of their own.
"""

from pyspark.sql import functions as F

from scorepipe.operators import metrics, models, sampling
from scorepipe.operators.encode import fit_scaler
from scorepipe.plans import tracking, training
from scorepipe.queries.base import CARD, CARD_INTERCEPT, FEATURES, KEY, LABEL, SPLIT_SQL, gold, nice, query, with_ctes
from scorepipe.queries.evaluation import compare_digits, compare_sql, two_runs
from scorepipe.session import work_path
from scorepipe.sources.tables import materialise

ROUNDS = 100
NORMAL = models.TUNED["Normal Sampling"]
SEARCH_DRAWS = 200

_SPLIT = {"sp": SPLIT_SQL.format(src="gold")}
_FOLDS = with_ctes("gold", "SELECT CAST(f AS INT) AS fold, (SELECT count(*) FROM gold) // 5 + CASE WHEN f < (SELECT count(*) FROM gold) % 5 THEN 1 ELSE 0 END AS n, true AS valid FROM range(5) r(f)")


def within(name, low=0.0, high=1.0):
    return F.coalesce((F.col(name) >= low) & (F.col(name) <= high), F.lit(False))


def of_folds(scores, folds):
    """(fold, n, valid): the rows of each fold and whether its score is a share."""
    n = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return n.join(scores, "fold").select(F.col("fold").cast("int").alias("fold"), "n", within("score").alias("valid"))


def parts(spark, d):
    rows = materialise(sampling.stratified_split(materialise(gold(spark, d)), LABEL, KEY))
    return rows.filter(F.col("split") == "train").drop("split"), rows.filter(F.col("split") == "test").drop("split")


@query("g2_logistic")
def g2(spark, d):
    """Coefficients of the scaled logistic regression on the training part."""
    train, _ = parts(spark, d)
    model, _ = models.scaled_logistic(train, FEATURES, LABEL)
    return models.coefficients(model)


@query("g2_logistic_optimum", "SELECT f AS feature, true AS valid FROM (VALUES ('intercept'), " + ", ".join(f"('{c}')" for c in FEATURES) + ") v(f)")
def g2_optimum(spark, d):
    """Of every coefficient: at the fitted values the penalised loss has no slope left along it."""
    train, _ = parts(spark, d)
    model, _ = models.scaled_logistic(train, FEATURES, LABEL)
    weight = {r["feature"]: r["weight"] for r in models.coefficients(model).collect()}
    stats = {r["column"]: (r["mean"], r["std_pop"]) for r in fit_scaler(train, FEATURES).collect()}
    scored = models.score(model, train, KEY, FEATURES)
    miss = F.col("score") - F.col("label")
    scaled = {c: (F.col(c) - (stats[c][0] or 0.0)) / (stats[c][1] or 1.0) for c in FEATURES}
    pulls = [F.struct(F.sum(miss * z).alias("slope"), F.sum(F.abs(miss * z)).alias("size")).alias(c) for c, z in {"intercept": F.lit(1.0), **scaled}.items()]
    one = scored.agg(*pulls)
    cells = [
        F.struct(F.lit(c).alias("feature"), (F.abs(F.col(c)["slope"] + (0.0 if c == "intercept" else w)) <= 1e-3 * F.col(c)["size"] + 1e-6).alias("valid"))
        for c, w in weight.items()
    ]
    return one.select(F.inline(F.array(*cells)))


@query("g3_boosted_trees", with_ctes("gold", "SELECT split, count(*) AS n, true AS valid FROM sp GROUP BY split", **_SPLIT))
def g3(spark, d):
    """Train and test rows of one boosted model; valid: it ranks about as well as the scorecard or better, and nearly all trees split."""
    train, test = parts(spark, d)
    model = models.fit_gbt(train, FEATURES, LABEL, NORMAL, ROUNDS)
    splits = sum(t.numNodes > 1 for t in model.core.trees) > 0.9 * ROUNDS
    rows = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    own = models.score(model, rows, KEY, ["split"]).select("split", "label", "score", F.lit("model").alias("by"))
    card = models.score_linear(rows, CARD, CARD_INTERCEPT).select("split", F.col(LABEL).cast("int").alias("label"), "score", F.lit("card").alias("by"))
    ranked = metrics.rank_metrics(materialise(own.unionByName(card)), "label", "score", ["split", "by"])
    both = ranked.groupBy("split").agg(
        F.max(F.col("n_pos") + F.col("n_neg")).alias("n"), F.max("n_pos").alias("events"), *[F.max(F.when(F.col("by") == by, F.col("auc"))).alias(by) for by in ("model", "card")]
    )
    near = 0.05 + 0.5 / F.sqrt("events")  # of few events an area is known no better
    return both.select("split", "n", (F.lit(splits) & F.coalesce(F.col("model") > F.col("card") - near, F.lit(False))).alias("valid"))


@query("g5_score", with_ctes("gold", "SELECT id, CAST(de_pay AS INT) AS label, true AS valid FROM sp WHERE split = 'test'", **_SPLIT))
def g5(spark, d):
    train, test = parts(spark, d)
    model, prepare = models.scaled_logistic(train, FEATURES, LABEL)
    return models.score(model, prepare(test), KEY).select("id", "label", within("score").alias("valid"))


@query("g6_cv_logistic", _FOLDS)
def g6(spark, d):
    folds = materialise(sampling.stratified_kfold(materialise(gold(spark, d)), LABEL, KEY))
    return of_folds(models.cross_validate(folds, models.scaled_logistic, FEATURES, LABEL, KEY, "accuracy"), folds)


@query("g7_cv_boosted", _FOLDS)
def g7(spark, d):
    folds = materialise(sampling.kfold(materialise(gold(spark, d)), KEY))
    return of_folds(models.cross_validate_boosted(folds, FEATURES, LABEL, [NORMAL], "label_auc", rounds=ROUNDS).drop("draw"), folds)


@query("g8_random_search", f"SELECT CAST(i AS INT) AS draw, CAST(5 AS BIGINT) AS folds, true AS valid FROM range({SEARCH_DRAWS}) r(i)")
def g8(spark, d):
    """Draws from the full grid with five folds; valid: exactly one is best, and its mean is the largest."""
    folds = materialise(sampling.stratified_kfold(materialise(gold(spark, d)), LABEL, KEY))
    found = models.random_search(folds, FEATURES, LABEL, KEY, n=SEARCH_DRAWS, rounds=ROUNDS)
    best = found.agg(F.sum(F.col("best").cast("int")).alias("k"), F.max("mean").alias("top"), F.max(F.when(F.col("best"), F.col("mean"))).alias("own"))
    ok = best.select(((F.col("k") == 1) & (F.col("top") == F.col("own"))).alias("ok")).scalar()
    return found.select("draw", "folds", (ok & within("mean", 0.5)).alias("valid"))


@query("f7_strategy_sweep", (
    "SELECT s AS strategy, p AS split, true AS valid FROM (VALUES ('Normal Sampling'), ('Manual Oversampling'), ('SMOTE')) a(s), (VALUES ('train'), ('test')) b(p)"))
def f7(spark, d):
    train, test = parts(spark, d)
    specs = training.strategies(LABEL, KEY, FEATURES)
    table = training.strategy_sweep(train, test, specs, FEATURES, LABEL, KEY, rounds=ROUNDS)[1]
    return table.select("strategy", "split", (within("auc", 0.5) & within("accuracy")).alias("valid"))


@query("g10_train_evaluate", with_ctes(
    "gold",
    "SELECT CAST(de_pay AS VARCHAR) AS \"class\", count(*) AS support, true AS valid FROM sp WHERE split = 'test' GROUP BY 1 UNION ALL "
    "SELECT c, (SELECT count(*) FROM sp WHERE split = 'test'), true FROM (VALUES ('accuracy'), ('macro avg'), ('weighted avg')) v(c)", **_SPLIT))
def g10(spark, d):
    """The class report of one strategy, after fit, scoring and cross-validation."""
    train, test = parts(spark, d)
    spec = training.Spec("Normal Sampling", NORMAL)
    report = training.train_evaluate(spec, train, test, FEATURES, LABEL, KEY, rounds=ROUNDS, folds=5).report
    return report.select("class", "support", (within("precision") & within("recall") & within("f1")).alias("valid"))


@query("l7_batch_scoring", with_ctes("gold", "SELECT id, CAST(de_pay AS INT) AS label, true AS valid FROM sp WHERE split = 'test'", **_SPLIT))
def l7(spark, d):
    """A model is logged, loaded again and scores a table; valid: the scores equal those of the model in memory."""
    train, test = parts(spark, d)
    model, _ = models.scaled_logistic(train, FEATURES, LABEL)
    store = tracking.RunStore(spark, work_path(spark, "tracking"))
    loaded = store.load_model(store.log_model(store.start_run("batch", "logistic"), model, "logistic"))
    now = models.score(model, test, KEY).select("id", F.col("score").alias("own"))
    return models.score(loaded, test, KEY).join(now, "id").select("id", "label", (F.abs(F.col("score") - F.col("own")) < 1e-12).alias("valid"))


@query("j6_compare_tracked_runs", compare_sql(tracking.LOGGED))
def j6(spark, d):
    """Both cards logged as runs, then compared from the tracking tables."""
    store = tracking.RunStore(spark, work_path(spark, "tracking"))
    rep = metrics.class_report(two_runs(spark, d), "label", "pred", ["run"])
    for row in metrics.run_metrics(rep, ["run"]).collect():
        run = store.start_run("cards", row["run"])
        store.log_params(run, {"kind": "card"})
        store.log_metrics(run, {n: row[n] for n in tracking.LOGGED})
    return nice(store.compare("first card"), compare_digits(tracking.LOGGED))
