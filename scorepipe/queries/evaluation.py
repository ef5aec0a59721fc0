"""Evaluation of scored rows."""

from functools import reduce

from pyspark.sql import functions as F

from scorepipe.operators import metrics, sampling
from scorepipe.operators.models import score_linear
from scorepipe.queries.base import (
    CARD, CARD_INTERCEPT, KEY, LABEL, SECOND_CARD, SECOND_INTERCEPT, SPLIT_SQL, dbl, documents_scored, events_scored, gold,
    lineitem_scored, margin_sql, nice, query, rnd, scored, with_ctes,
)


def _curve_ctes(source: str, group: str, label: str, score: str) -> dict[str, str]:
    """Running class counts from the highest score down, by plain windows."""
    return {
        "pts": f"SELECT {group} AS g, CAST({score} AS DOUBLE) AS s, sum(CASE WHEN {label} = 1 THEN 1 ELSE 0 END) AS np, "
        f"sum(CASE WHEN {label} = 1 THEN 0 ELSE 1 END) AS nn FROM {source} GROUP BY 1, 2",
        "run": "SELECT g, s, np, nn, CAST(sum(np) OVER w AS DOUBLE) AS tp, CAST(sum(nn) OVER w AS DOUBLE) AS fp, "
        "CAST(sum(np) OVER (PARTITION BY g) AS DOUBLE) AS p, CAST(sum(nn) OVER (PARTITION BY g) AS DOUBLE) AS n, "
        "lead(np) OVER w AS np2, lead(nn) OVER w AS nn2, row_number() OVER w AS rn FROM pts "
        "WINDOW w AS (PARTITION BY g ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "rk": "SELECT g, CAST(sum(np) AS BIGINT) AS n_pos, CAST(sum(nn) AS BIGINT) AS n_neg, "
        "sum(np * (n - fp + nn / CAST(2 AS DOUBLE))) / nullif(max(p) * max(n), 0) AS auc, "
        # NULL without both classes; greatest alone would skip the NULL
        "CASE WHEN max(p) > 0 AND max(n) > 0 THEN greatest(max(tp / nullif(p, 0) - fp / nullif(n, 0)), 0) END AS ks_roc, "
        "max(abs(tp / nullif(p, 0) - fp / nullif(n, 0))) AS ks_2samp FROM run GROUP BY g",
    }


_RANKED = (
    "n_pos, n_neg, " + rnd("auc", 6) + " AS auc, " + rnd("2 * auc - 1", 6) + " AS gini, " + rnd("ks_roc", 6) + " AS ks_roc, "
    + rnd("ks_2samp", 6) + " AS ks_2samp FROM rk"
)
_DIGITS = {"auc": 6, "gini": 6, "ks_roc": 6, "ks_2samp": 6}
_CARD = _curve_ctes("scored", "0", "label", "score")
_CARD_BY = _curve_ctes("scored", "grp", "label", "score")


@query("flagship_discrimination", with_ctes(
    "silver", "SELECT " + _RANKED, **_curve_ctes("silver", "0", "de_pay", "pay_1 * CAST(1000000 AS DOUBLE) + limit_bal")))
def flagship(spark, d):
    """How well does a simple score separate defaulters?"""
    s = gold(spark, d).withColumn("score", F.col("pay_1") * F.lit(1000000.0).cast("double") + F.col("limit_bal"))
    return nice(metrics.rank_metrics(s, LABEL, "score"), _DIGITS)


@query("h1_accuracy", with_ctes("scored", "SELECT grp, " + rnd("avg(CAST(label = pred AS INT))", 6) + " AS accuracy FROM scored GROUP BY grp"))
def h1(spark, d):
    return nice(metrics.accuracy(scored(spark, d), "label", "pred", ["grp"]), {"accuracy": 6})


_GRID = "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(label, pred)"


@query(
    "h2_confusion",
    with_ctes(
        "scored",
        "SELECT g.grp, c.label, c.pred, count(s.id) AS n FROM (SELECT DISTINCT grp FROM scored) g CROSS JOIN " + _GRID
        + " LEFT JOIN scored s ON s.grp = g.grp AND s.label = c.label AND s.pred = c.pred GROUP BY ALL",
    ),
)
def h2(spark, d):
    return metrics.confusion(scored(spark, d), "label", "pred", ["grp"])


def _report_ctes(group: str = "grp", src: str = "scored") -> dict[str, str]:
    base = (
        f"SELECT {group} AS g, k.k AS k, CAST(count(*) FILTER (label = k.k AND pred = k.k) AS DOUBLE) AS tp, "
        f"CAST(count(*) FILTER (pred = k.k) AS DOUBLE) AS pp, CAST(count(*) FILTER (label = k.k) AS DOUBLE) AS sup, count(*) AS total "
        f"FROM {src}, (VALUES (0), (1)) k(k) GROUP BY 1, 2"
    )
    return {
        "cnt": base,
        "pr": "SELECT g, k, tp, sup, total, coalesce(tp / nullif(pp, 0), 0) AS pre, coalesce(tp / nullif(sup, 0), 0) AS rec FROM cnt",
        "f": "SELECT *, coalesce(2 * pre * rec / nullif(pre + rec, 0), 0) AS f1 FROM pr",
        "rep": 'SELECT g, CAST(k AS VARCHAR) AS "class", pre AS "precision", rec AS recall, f1, CAST(sup AS BIGINT) AS support FROM f UNION ALL '
        "SELECT g, 'accuracy', sum(tp) / max(total), sum(tp) / max(total), sum(tp) / max(total), CAST(max(total) AS BIGINT) FROM f GROUP BY g UNION ALL "
        "SELECT g, 'macro avg', avg(pre), avg(rec), avg(f1), CAST(max(total) AS BIGINT) FROM f GROUP BY g UNION ALL "
        "SELECT g, 'weighted avg', sum(pre * sup) / max(total), sum(rec * sup) / max(total), sum(f1 * sup) / max(total), CAST(max(total) AS BIGINT) FROM f GROUP BY g",
    }


_REPORT = 'SELECT g AS grp, "class", ' + rnd('"precision"', 6) + ' AS "precision", ' + rnd("recall", 6) + " AS recall, " + rnd("f1", 6) + " AS f1, support FROM rep"
_PRF = {"precision": 6, "recall": 6, "f1": 6}


@query("h3_class_report", with_ctes("scored", _REPORT + " WHERE \"class\" IN ('0', '1')", **_report_ctes()))
def h3(spark, d):
    rep = metrics.class_report(scored(spark, d), "label", "pred", ["grp"])
    return nice(rep.filter(F.col("class").isin("0", "1")), _PRF)


@query("h4_averages", with_ctes("scored", _REPORT + " WHERE \"class\" NOT IN ('0', '1')", **_report_ctes()))
def h4(spark, d):
    return nice(metrics.averages(metrics.class_report(scored(spark, d), "label", "pred", ["grp"])), _PRF)


@query(
    "h3_report_documents",
    with_ctes("", 'SELECT g AS lang, "class", ' + _REPORT.split('"class", ', 1)[1],
              docs="SELECT lang, quality AS label, toxic AS pred FROM documents JOIN labels USING (doc_id)", **_report_ctes("lang", "docs")),
)
def h3_documents(spark, d):
    """Quality label against toxicity flag, per language."""
    return nice(metrics.class_report(documents_scored(spark, d), "quality", "toxic", ["lang"]), _PRF)


_NAMES = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_no_default", "recall_default"]
_NAMED = {
    "accuracy": ("accuracy", "f1"), "precision_macro": ("macro avg", '"precision"'), "recall_macro": ("macro avg", "recall"),
    "f1_macro": ("macro avg", "f1"), "recall_no_default": ("0", "recall"), "recall_default": ("1", "recall"),
}


def _named_sql(names) -> str:
    return ", ".join(rnd(f"max({_NAMED[n][1]}) FILTER (\"class\" = '{_NAMED[n][0]}')", 6) + f" AS {n}" for n in names)


@query("h4b_named_recalls", with_ctes("scored", "SELECT g AS grp, " + _named_sql(_NAMES[-2:]) + " FROM rep GROUP BY g", **_report_ctes()))
def h4b(spark, d):
    rep = metrics.class_report(scored(spark, d), "label", "pred", ["grp"])
    out = metrics.run_metrics(rep, ["grp"]).select("grp", "recall_no_default", "recall_default")
    return nice(out, {"recall_no_default": 6, "recall_default": 6})


@query("h5_auc", with_ctes("scored", "SELECT g AS grp, " + rnd("auc", 6) + " AS auc FROM rk", **_CARD_BY))
def h5(spark, d):
    return nice(metrics.auc(scored(spark, d), "label", "score", ["grp"]), _DIGITS)


@query("h5_auc_lineitem", with_ctes(
    "", "SELECT g AS l_linestatus, " + rnd("auc", 6) + " AS auc FROM rk",
    li="SELECT l_linestatus, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem",
    **_curve_ctes("li", "l_linestatus", "label", "l_extendedprice")))
def h5_lineitem(spark, d):
    return nice(metrics.auc(lineitem_scored(spark, d), "label", "l_extendedprice", ["l_linestatus"]), _DIGITS)


@query("h5b_label_auc", with_ctes(
    "scored", "SELECT g AS grp, " + rnd("auc", 6) + " AS label_auc FROM rk", **_curve_ctes("scored", "grp", "label", "pred")))
def h5b(spark, d):
    return nice(metrics.label_auc(scored(spark, d), "label", "pred", ["grp"]), {"label_auc": 6})


_ROC = (
    "CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr FROM (SELECT DISTINCT g FROM run) t "
    "UNION ALL SELECT {g}" + rnd("s", 6) + ", " + rnd("fp / nullif(n, 0)", 6) + ", " + rnd("tp / nullif(p, 0)", 6) + " FROM run"
)
_BEND = " WHERE rn = 1 OR np2 IS NULL OR np2 <> np OR nn2 <> nn"


@query("h6_roc_curve", with_ctes("scored", "SELECT g AS grp, " + _ROC.format(g="g, ") + _BEND, **_CARD_BY))
def h6(spark, d):
    return nice(metrics.roc_curve(scored(spark, d), "label", "score", ["grp"]), {"threshold": 6, "fpr": 6, "tpr": 6})


@query("h6_roc_events", with_ctes(
    "", "SELECT " + _ROC.format(g=""), ev="SELECT value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events",
    **_curve_ctes("ev", "0", "label", "value")))
def h6_events(spark, d):
    """Every distinct score, without leaving out straight stretches."""
    out = metrics.roc_curve(events_scored(spark, d), "label", "value", drop_collinear=False)
    return nice(out, {"threshold": 6, "fpr": 6, "tpr": 6})


@query("h7_ks_roc", with_ctes("scored", "SELECT g AS grp, " + rnd("ks_roc", 6) + " AS ks_roc FROM rk", **_CARD_BY))
def h7(spark, d):
    return nice(metrics.ks_roc(scored(spark, d), "label", "score", ["grp"]), _DIGITS)


@query("h8_ks_2samp", with_ctes("scored", "SELECT g AS grp, " + rnd("ks_2samp", 6) + " AS ks_2samp FROM rk", **_CARD_BY))
def h8(spark, d):
    return nice(metrics.ks_2samp(scored(spark, d), "label", "score", ["grp"]), _DIGITS)


@query("h9_gini", with_ctes("scored", "SELECT g AS grp, " + rnd("2 * auc - 1", 6) + " AS gini FROM rk", **_CARD_BY))
def h9(spark, d):
    return nice(metrics.gini(scored(spark, d), "label", "score", ["grp"]), _DIGITS)


@query("h_discrimination_events", with_ctes(
    "", "SELECT " + _RANKED, ev="SELECT value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events",
    **_curve_ctes("ev", "0", "label", "value")))
def h_events(spark, d):
    return nice(metrics.rank_metrics(events_scored(spark, d), "label", "value"), _DIGITS)


@query("h_discrimination_documents", with_ctes(
    "", "SELECT g AS lang, " + _RANKED, docs="SELECT lang, n_chars, quality FROM documents JOIN labels USING (doc_id)",
    **_curve_ctes("docs", "lang", "quality", "n_chars")))
def h_documents(spark, d):
    return nice(metrics.rank_metrics(documents_scored(spark, d), "quality", "n_chars", ["lang"]), _DIGITS)


@query("h10_band", with_ctes(
    "scored",
    "SELECT grp, metric, " + rnd("value", 6) + " AS value, CASE WHEN value IS NULL THEN NULL WHEN metric = 'ks' AND value > 0.4 THEN 'good' "
    "WHEN metric = 'gini' AND value > 0.6 THEN 'good' ELSE 'weak' END AS band FROM "
    "(SELECT g AS grp, 'ks' AS metric, ks_roc AS value FROM rk UNION ALL SELECT g, 'gini', 2 * auc - 1 FROM rk) t", **_CARD_BY))
def h10(spark, d):
    m = metrics.rank_metrics(scored(spark, d), "label", "score", ["grp"]).withColumnRenamed("ks_roc", "ks")
    return nice(metrics.band(metrics.to_long(m, ["ks", "gini"], ["grp"])), {"value": 6})


def two_runs(spark, d):
    """Both cards as two runs over the same rows: (run, label, score, pred)."""
    g = gold(spark, d)
    cards = {"first card": (CARD, CARD_INTERCEPT), "second card": (SECOND_CARD, SECOND_INTERCEPT)}
    frames = [
        metrics.predict_label(score_linear(g, w, b)).select(F.lit(n).alias("run"), F.col(LABEL).alias("label"), "score", "pred")
        for n, (w, b) in cards.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


_RUNS = {
    "cards": f"SELECT 'first card' AS run, de_pay AS label, score, pred FROM scored UNION ALL SELECT 'second card', de_pay, s2, "
    f"CASE WHEN s2 > 0.5 THEN 1 ELSE 0 END FROM (SELECT de_pay, {dbl(1.0)} / ({dbl(1.0)} + exp(-({margin_sql(SECOND_CARD, SECOND_INTERCEPT)}))) AS s2 FROM gold) t",
    **_report_ctes("run", "cards"),
    "m": "SELECT g AS run, max(f1) FILTER (\"class\" = 'accuracy') AS accuracy, max(\"precision\") FILTER (\"class\" = 'macro avg') AS precision_macro, "
    "max(recall) FILTER (\"class\" = 'macro avg') AS recall_macro, max(f1) FILTER (\"class\" = 'macro avg') AS f1_macro, "
    "max(recall) FILTER (\"class\" = '0') AS recall_no_default, max(recall) FILTER (\"class\" = '1') AS recall_default FROM rep GROUP BY g",
}


def compare_sql(names) -> str:
    return with_ctes(
        "scored",
        "SELECT m.run, " + ", ".join(rnd(f"m.{n}", 6) + f" AS {n}, " + rnd(f"m.{n} - b.{n}", 6) + f" AS {n}_delta" for n in names)
        + " FROM m, (SELECT * FROM m WHERE run = 'first card') b",
        **_RUNS,
    )


def compare_digits(names) -> dict[str, int]:
    return {c: 6 for n in names for c in (n, f"{n}_delta")}


@query("h11_compare_runs", compare_sql(["accuracy", "recall_default"]))
def h11(spark, d):
    """Accuracy against recall of positives, one row per run."""
    rep = metrics.class_report(two_runs(spark, d), "label", "pred", ["run"])
    names = ["accuracy", "recall_default"]
    long = metrics.to_long(metrics.run_metrics(rep, ["run"]), names, ["run"])
    return nice(metrics.compare_runs(long, "first card", names), compare_digits(names))


@query("g4_predict_label", with_ctes("probs", "SELECT id, CASE WHEN score > 0.3 THEN 1 ELSE 0 END AS pred FROM probs"))
def g4(spark, d):
    return metrics.predict_label(scored(spark, d).drop("pred"), "score", 0.3).select(KEY, "pred")


@query("g5b_score_linear", with_ctes("probs", "SELECT id, " + rnd("score", 8) + " AS score FROM probs"))
def g5b(spark, d):
    return nice(score_linear(gold(spark, d), CARD, CARD_INTERCEPT).select(KEY, "score"), {"score": 8})


@query("g9_evaluate", with_ctes(
    "scored",
    "SELECT split, " + rnd("avg(CAST(label = pred AS INT))", 6) + " AS accuracy, (SELECT " + rnd("auc", 6) + " FROM rk WHERE g = split) AS auc FROM parts GROUP BY split",
    parts=SPLIT_SQL.format(src="scored"), **_curve_ctes("parts", "split", "label", "score")))
def g9(spark, d):
    parts = sampling.stratified_split(scored(spark, d), LABEL, KEY)
    return nice(metrics.evaluate(parts), {"accuracy": 6, "auc": 6})
