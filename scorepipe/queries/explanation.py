"""Attribution of scores to features."""

from pyspark.sql import functions as F

from scorepipe.functions.columns import rounded
from scorepipe.operators import explain, models
from scorepipe.queries.base import CARD, CARD_INTERCEPT, FEATURES, KEY, LABEL, SPLIT_SQL, dbl, gold, nice, query, rnd, with_ctes
from scorepipe.queries.modelling import NORMAL, ROUNDS, parts

_COLS = list(CARD)
_ROW = 11


def card_shap(spark, d):
    g = gold(spark, d)
    means = g.agg(*[F.avg(c).alias(c) for c in _COLS]).first().asDict()
    return g, explain.linear_shap(g, CARD, means, KEY, CARD_INTERCEPT)


_CONTRIB = {
    "mu": "SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in _COLS) + " FROM gold",
    "ct": "SELECT id, de_pay, " + " + ".join([dbl(CARD_INTERCEPT), *[f"{dbl(w)} * m_{c}" for c, w in CARD.items()]]) + " AS base, "
    + ", ".join(f"{dbl(w)} * (CAST({c} AS DOUBLE) - m_{c}) AS {c}" for c, w in CARD.items()) + " FROM gold, mu",
    "lg": " UNION ALL ".join(f"SELECT id, de_pay, base, '{c}' AS feature, {c} AS contribution FROM ct" for c in _COLS),
}


@query("i1b_linear_shap", with_ctes(
    "gold", "SELECT id, " + rnd("base", 6) + " AS base_value, feature, " + rnd("contribution", 6) + " AS contribution FROM lg", **_CONTRIB))
def i1b(spark, d):
    _, shap = card_shap(spark, d)
    long = explain.long_contributions(shap, _COLS).join(shap.select("id", "base_value"), "id")
    return nice(long.select("id", "base_value", "feature", "contribution"), {"base_value": 6, "contribution": 6})


# card margins have seven decimals; rounding them to six would meet exact ties
@query("i3_explain_row", with_ctes(
    "gold",
    "SELECT lg.feature, " + rnd("v.value", 8) + " AS value, " + rnd("contribution", 8) + " AS contribution, " + rnd("base", 8) + " AS base_value, "
    + rnd("t.margin", 8) + " AS margin, CASE WHEN t.margin > 0 THEN 1 ELSE 0 END AS pred, lg.de_pay AS actual "
    "FROM lg JOIN (SELECT id, max(base) + sum(contribution) AS margin FROM lg GROUP BY id) t ON t.id = lg.id "
    "JOIN (" + " UNION ALL ".join(f"SELECT id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM gold" for c in _COLS)
    + f") v ON v.id = lg.id AND v.feature = lg.feature WHERE lg.id = {_ROW}", **_CONTRIB))
def i3(spark, d):
    g, shap = card_shap(spark, d)
    out = explain.explain_row(shap, g, _ROW, _COLS, KEY, LABEL)
    return nice(out, {"value": 8, "contribution": 8, "base_value": 8, "margin": 8})


@query("i4_waterfall", with_ctes(
    "gold",
    "SELECT CAST(pos AS INT) AS pos, feature, " + rnd("contribution", 8) + " AS contribution, " + rnd("base + run - contribution", 8) + " AS start, "
    + rnd("base + run", 8) + " AS stop FROM w2",
    **_CONTRIB,
    w0=f"SELECT *, row_number() OVER (ORDER BY abs(contribution) DESC, feature) AS rn FROM lg WHERE id = {_ROW}",
    w1="SELECT least(rn, 4) AS pos, CASE WHEN rn <= 3 THEN feature ELSE '3 other features' END AS feature, max(base) AS base, sum(contribution) AS contribution FROM w0 GROUP BY 1, 2",
    w2="SELECT *, sum(contribution) OVER (ORDER BY pos DESC) AS run FROM w1"))
def i4(spark, d):
    _, shap = card_shap(spark, d)
    return nice(explain.waterfall(shap, _ROW, _COLS, max_display=4), {"contribution": 8, "start": 8, "stop": 8})


@query("i5_shap_importance", with_ctes(
    "gold", "SELECT feature, " + rnd("avg(abs(contribution))", 6) + " AS importance FROM lg GROUP BY feature ORDER BY importance DESC, feature LIMIT 5", **_CONTRIB))
def i5(spark, d):
    _, shap = card_shap(spark, d)
    return nice(explain.shap_importance(shap, _COLS, 5), {"importance": 6})


@query("i7_rank_compare", with_ctes(
    "gold",
    "SELECT a.feature, CAST(a.r AS INT) AS all_rank, CAST(b.r AS INT) AS positive_rank, CAST(a.r - b.r AS INT) AS shift FROM "
    "(SELECT feature, rank() OVER (ORDER BY avg(abs(contribution)) DESC) AS r FROM lg GROUP BY feature) a JOIN "
    "(SELECT feature, rank() OVER (ORDER BY avg(abs(contribution)) DESC) AS r FROM lg WHERE de_pay = 1 GROUP BY feature) b USING (feature)", **_CONTRIB))
def i7(spark, d):
    """Importance over all rows against importance over the positives."""
    g, shap = card_shap(spark, d)
    positives = shap.join(g.filter(F.col(LABEL) == 1).select(F.col(KEY).alias("id")), "id", "left_semi")
    a, b = explain.shap_importance(shap, _COLS), explain.shap_importance(positives, _COLS)
    return explain.rank_compare(a, b, "all", "positive")


def _boosted(spark, d):
    train, test = parts(spark, d)
    return models.fit_gbt(train, FEATURES, LABEL, NORMAL, ROUNDS), test


@query("i1_tree_shap", with_ctes("gold", "SELECT id, true AS valid FROM sp WHERE split = 'test'", sp=SPLIT_SQL.format(src="gold")))
def i1(spark, d):
    """Of every test row: do base value and contributions add up to the log-odds of its score?"""
    model, test = _boosted(spark, d)
    shap = explain.tree_shap(model, test, KEY)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, x: a + x)
    odds = models.score(model, test, KEY).select("id", F.log(F.col("score") / (1 - F.col("score"))).alias("odds"))
    return shap.select("id", total.alias("total")).join(odds, "id").select("id", (F.abs(F.col("total") - F.col("odds")) < 1e-9).alias("valid"))


@query("i2_base_value")
def i2(spark, d):
    model, test = _boosted(spark, d)
    return test.select(F.col(KEY).alias("id"), F.lit(explain.base_value(explain.leaf_paths(explain.tree_nodes(model)))).alias("base_value"))


@query("i3_explain_tree_row")
def i3_tree(spark, d):
    model, test = _boosted(spark, d)
    first = test.agg(F.min(KEY)).first()[0]
    one = test.filter(F.col(KEY) == first)
    return explain.explain_row(explain.tree_shap(model, one, KEY), one, first, FEATURES, KEY, LABEL)


@query("i6_gain_importance")
def i6(spark, d):
    return explain.gain_importance(_boosted(spark, d)[0])


@query("i7_gain_against_shap")
def i7_tree(spark, d):
    model, test = _boosted(spark, d)
    gain = explain.gain_importance(model, len(FEATURES))
    return explain.rank_compare(gain, explain.shap_importance(explain.tree_shap(model, test, KEY), FEATURES, len(FEATURES)))


_FEATURE_LIST = ", ".join(f"('{c}')" for c in FEATURES)


@query("i6_gain_shares", f"SELECT f AS feature, true AS valid FROM (VALUES {_FEATURE_LIST}) v(f)")
def i6_shares(spark, d):
    """Of every feature: its importance is its share of the gains in the node table, and all shares make one."""
    model, _ = _boosted(spark, d)
    inner = explain.tree_nodes(model).filter("left >= 0")
    gains = inner.groupBy("feature").agg(F.sum("gain").alias("gain"), F.min("gain").alias("least"))
    whole = inner.agg(F.sum("gain").alias("whole"))
    names = spark.createDataFrame(list(enumerate(FEATURES)), "feature INT, name STRING")
    own = names.join(gains, "feature", "left").join(F.broadcast(whole)).select(F.col("name").alias("feature"), (F.coalesce("gain", F.lit(0.0)) / F.col("whole")).alias("share"), "least")
    both = explain.gain_importance(model, len(FEATURES)).join(own, "feature")
    one = both.agg(F.abs(F.sum("importance") - 1) < 1e-9).first()[0]
    return both.select("feature", (F.lit(one) & (F.abs(F.col("importance") - F.col("share")) < 1e-9) & (F.coalesce("least", F.lit(1.0)) > 0)).alias("valid"))


@query("i2_base_is_cover_mean", f"SELECT CAST(t AS INT) AS tree, true AS valid FROM range({ROUNDS}) r(t)")
def i2_mean(spark, d):
    """Of every tree: the covers of its leaves make that of its root; and the base value is the mean of all leaves by cover."""
    model, _ = _boosted(spark, d)
    nodes = explain.tree_nodes(model)
    leaf = F.col("left") < 0
    trees = nodes.groupBy("tree").agg(
        F.sum(F.when(leaf, F.col("cover"))).alias("leaves"), F.max(F.when(F.col("node") == 0, F.col("cover"))).alias("root"),
        F.sum(F.when(leaf, 2 * F.col("tree_weight") * F.col("value") * F.col("cover"))).alias("weighted"),
    )
    base = explain.base_value(explain.leaf_paths(nodes))
    mean = trees.agg(F.sum(F.col("weighted") / F.col("root"))).first()[0]
    return trees.select("tree", (F.lit(abs(base - mean) < 1e-9) & (F.abs(F.col("leaves") / F.col("root") - 1) < 1e-9)).alias("valid"))
