"""Decisions from scores, next to plain SQL."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from scorepipe.operators import binning, isotonic, risk
from scorepipe.queries.base import BILLS, LABEL, PAYS, documents_labelled, gold, lineitem_scored, nice, query, rnd, scored, silver, with_ctes
from scorepipe.queries.evaluation import _CARD_BY, _curve_ctes
from scorepipe.sources.tables import materialise, read_parquet

_COST = "fp * CAST(1 AS DOUBLE) + (p - tp) * CAST(5 AS DOUBLE)"


@query("l1_threshold_costs", with_ctes(
    "scored", f"SELECT g AS grp, {rnd('s', 8)} AS threshold, CAST(fp AS BIGINT) AS fp, CAST(p - tp AS BIGINT) AS fn, {_COST} AS cost FROM run", **_CARD_BY))
def l1(spark, d):
    """A missed default costs five times a false alarm."""
    out = risk.threshold_costs(scored(spark, d), "label", "score", 1, 5, ["grp"])
    return nice(out.withColumns({c: F.col(c).cast("bigint") for c in ("fp", "fn")}), {"threshold": 8})


@query("l1_best_threshold", with_ctes(
    "", f"SELECT g AS l_linestatus, max(s) AS threshold, min(cost) AS cost FROM (SELECT *, {_COST} AS cost, min({_COST}) OVER (PARTITION BY g) AS least FROM run) "
    "WHERE cost = least GROUP BY g",
    **_curve_ctes("(SELECT l_linestatus, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)", "l_linestatus", "label", "l_extendedprice")))
def l1_best(spark, d):
    costs = risk.threshold_costs(lineitem_scored(spark, d), "label", "l_extendedprice", 1, 5, ["l_linestatus"])
    return risk.best_threshold(costs, ["l_linestatus"]).select("l_linestatus", "threshold", "cost")


_WOE = "ln(((n_pos + 0.5) / (sum(n_pos) OVER w + 0.5)) / ((n_neg + 0.5) / (sum(n_neg) OVER w + 0.5)))"
_EVIDENCE = ["education", "marriage", "sex", "pay_1"]


@query("l2_weight_of_evidence", with_ctes(
    "silver",
    f'SELECT "column", level, n_pos, n_neg, {rnd(_WOE, 8)} AS woe, '
    + rnd(f"(n_pos / CAST(sum(n_pos) OVER w AS DOUBLE) - n_neg / CAST(sum(n_neg) OVER w AS DOUBLE)) * {_WOE}", 8)
    + ' AS iv FROM lv WINDOW w AS (PARTITION BY "column")',
    lv=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, CAST(sum(CASE WHEN de_pay = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos, "
        f"CAST(sum(CASE WHEN de_pay = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg FROM silver GROUP BY 1, 2" for c in _EVIDENCE)))
def l2(spark, d):
    return nice(risk.weight_of_evidence(silver(spark, d), LABEL, _EVIDENCE), {"woe": 8, "iv": 8})


_BIN = "least(9, CAST(floor(score * 10) AS INT))"


@query("l3_reliability", with_ctes(
    "scored",
    f"SELECT grp, {_BIN} AS bin, count(*) AS n, {rnd('avg(score)', 8)} AS mean_score, {rnd('avg(CAST(label AS DOUBLE))', 8)} AS rate, "
    f"{rnd('avg((score - label) * (score - label))', 8)} AS brier FROM scored GROUP BY 1, 2"))
def l3(spark, d):
    out = risk.reliability(scored(spark, d), "label", "score", by=["grp"])
    return nice(out, {"mean_score": 8, "rate": 8, "brier": 8})


def _share(grp: int) -> str:
    return f"SELECT b.bin, greatest(coalesce(k / CAST((SELECT count(*) FROM scored WHERE grp = {grp}) AS DOUBLE), 0), 1e-4) AS share FROM range(10) b(bin) LEFT JOIN (SELECT {_BIN} AS bin, count(*) AS k FROM scored WHERE grp = {grp} GROUP BY 1) USING (bin)"


@query("l4_stability", with_ctes(
    "scored",
    f"SELECT CAST(e.bin AS INT) AS bin, {rnd('e.share', 8)} AS expected, {rnd('a.share', 8)} AS actual, {rnd('(a.share - e.share) * ln(a.share / e.share)', 8)} AS psi FROM base_share e JOIN now_share a ON e.bin = a.bin",
    base_share=_share(1), now_share=_share(2)))
def l4(spark, d):
    """Scores of two client groups against each other."""
    rows = scored(spark, d)
    out = risk.stability(rows.filter("grp = 1"), rows.filter("grp = 2"), "score")
    return nice(out, {"expected": 8, "actual": 8, "psi": 8})


# bins of quantiles

_AMOUNTS = ["limit_bal", "age", *BILLS, *PAYS]


def _cuts(src: str, where: str, cols: list[str], bins: int = 10) -> str:
    marks = "[" + ", ".join(str(i / bins) for i in range(1, bins)) + "]"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), {marks}))) AS cuts FROM {src} WHERE {where}" for c in cols)


def _binned(src: str, where: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter((SELECT cuts FROM cuts WHERE \"column\" = '{c}'), lambda q: q < {c})) END AS bin, de_pay FROM {src} WHERE {where}"
        for c in cols)


_EDGES = (
    "SELECT \"column\", CAST(b AS INT) AS bin, CASE WHEN b < 0 THEN NULL WHEN b = 0 THEN CAST('-inf' AS DOUBLE) ELSE cuts[b] END AS lo, "
    "CASE WHEN b < 0 THEN NULL WHEN b = len(cuts) THEN CAST('inf' AS DOUBLE) ELSE cuts[b + 1] END AS hi FROM (SELECT *, unnest(range(-1, len(cuts) + 1)) AS b FROM cuts)")
_PSI = "greatest(coalesce(k / CAST(sum(k) OVER (PARTITION BY \"column\") AS DOUBLE), 0), 1e-4)"


def _bin_shares(name: str) -> str:
    return f"SELECT \"column\", bin, {_PSI} AS share FROM edges LEFT JOIN (SELECT \"column\", bin, count(*) AS k FROM {name} GROUP BY 1, 2) USING (\"column\", bin)"


@query("l4_stability_by_bins", with_ctes(
    "gold",
    f"SELECT \"column\", bin, {rnd('lo', 6)} AS lo, {rnd('hi', 6)} AS hi, {rnd('e.share', 8)} AS expected, {rnd('a.share', 8)} AS actual, "
    f"{rnd('(a.share - e.share) * ln(a.share / e.share)', 8)} AS psi FROM edges JOIN base_share e USING (\"column\", bin) JOIN now_share a USING (\"column\", bin)",
    cuts=_cuts("gold", "sex_1 = 1", _AMOUNTS), edges=_EDGES, base_rows=_binned("gold", "sex_1 = 1", _AMOUNTS), now_rows=_binned("gold", "sex_1 <> 1", _AMOUNTS),
    base_share=_bin_shares("base_rows"), now_share=_bin_shares("now_rows")))
def l4_bins(spark, d):
    """All amounts of two client groups, in the decile bins of the first."""
    rows = gold(spark, d)
    base, now = rows.filter("sex_1 = 1"), rows.filter("sex_1 <> 1")
    out = binning.stability_by_bins(base, now, binning.fit_bins(base, _AMOUNTS))
    return nice(out, {"lo": 6, "hi": 6, "expected": 8, "actual": 8, "psi": 8})


_PART_WOE = "ln(((n_pos + 0.5) / (sum(n_pos) OVER w + 0.5)) / ((n_neg + 0.5) / (sum(n_neg) OVER w + 0.5)))"
_PART_IV = f"(n_pos / CAST(sum(n_pos) OVER w AS DOUBLE) - n_neg / CAST(sum(n_neg) OVER w AS DOUBLE)) * {_PART_WOE}"
_RATES = {
    "cuts": _cuts("gold", "true", _AMOUNTS),
    "edges": _EDGES,
    "bn": "SELECT \"column\", bin, lo, hi, n_pos, n_neg FROM edges JOIN (SELECT \"column\", bin, CAST(sum(CASE WHEN de_pay = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_pos, "
    "CAST(sum(CASE WHEN de_pay = 1 THEN 0 ELSE 1 END) AS BIGINT) AS n_neg FROM (" + _binned("gold", "true", _AMOUNTS) + ") GROUP BY 1, 2) USING (\"column\", bin)",
}


@query("l2_evidence_by_bins", with_ctes(
    "gold",
    f"SELECT \"column\", bin AS part, {rnd('lo', 6)} AS lo, {rnd('hi', 6)} AS hi, n_pos, n_neg, {rnd(_PART_WOE, 8)} AS woe, {rnd(_PART_IV, 8)} AS iv "
    "FROM bn WINDOW w AS (PARTITION BY \"column\")", **_RATES))
def l2_bins(spark, d):
    """Evidence of the decile bins of every amount."""
    rows = gold(spark, d)
    out = binning.evidence_by_bins(rows, LABEL, binning.fit_bins(rows, _AMOUNTS), monotone=False)
    return nice(out, {"lo": 6, "hi": 6, "woe": 8, "iv": 8})


# the isotonic rate of a bin is the largest, over the bins from which it may be reached, of the least mean rate up to the bins that it may reach
@query("l2_monotone_evidence", with_ctes(
    "gold",
    f"SELECT \"column\", CAST(part AS INT) AS part, {rnd('lo', 6)} AS lo, {rnd('hi', 6)} AS hi, n_pos, n_neg, {rnd('woe', 8)} AS woe, {rnd('iv', 8)} AS iv FROM parts JOIN "
    "(SELECT \"column\", max_by(rising, (value, rising)) AS rising FROM (SELECT \"column\", rising, round(sum(iv), 12) AS value FROM parts GROUP BY 1, 2) GROUP BY 1) USING (\"column\", rising)",
    **_RATES,
    ways="SELECT *, rising, CASE WHEN rising THEN bin ELSE -bin END AS at FROM bn, (VALUES (true), (false)) v(rising) WHERE bin >= 0",
    means="SELECT a.\"column\", a.rising, a.at AS f, b.at AS t, sum(c.n_pos) / CAST(sum(c.n_pos + c.n_neg) AS DOUBLE) AS m FROM ways a JOIN ways b ON a.\"column\" = b.\"column\" AND a.rising = b.rising "
    "AND a.at <= b.at JOIN ways c ON a.\"column\" = c.\"column\" AND a.rising = c.rising AND c.at BETWEEN a.at AND b.at GROUP BY 1, 2, 3, 4",
    iso="SELECT w.\"column\", w.rising, w.bin, lo, hi, n_pos, n_neg, (SELECT max(least_up) FROM (SELECT f, min(m) AS least_up FROM means x "
    "WHERE x.\"column\" = w.\"column\" AND x.rising = w.rising AND x.f <= w.at AND x.t >= w.at GROUP BY f)) AS rate FROM ways w",
    merged="SELECT \"column\", rising, min(bin) AS b, min(lo) AS lo, max(hi) AS hi, CAST(sum(n_pos) AS BIGINT) AS n_pos, CAST(sum(n_neg) AS BIGINT) AS n_neg FROM iso GROUP BY \"column\", rising, round(rate, 12)",
    numbered="SELECT \"column\", rising, row_number() OVER (PARTITION BY \"column\", rising ORDER BY b) - 1 AS part, lo, hi, n_pos, n_neg FROM merged",
    parts=f"SELECT \"column\", rising, part, lo, hi, n_pos, n_neg, {_PART_WOE} AS woe, {_PART_IV} AS iv FROM numbered WINDOW w AS (PARTITION BY \"column\", rising)"))
def l2_monotone(spark, d):
    """The same bins, merged until the default rate only rises or only falls."""
    rows = gold(spark, d)
    out = binning.evidence_by_bins(rows, LABEL, binning.fit_bins(rows, _AMOUNTS))
    return nice(out, {"lo": 6, "hi": 6, "woe": 8, "iv": 8})


_ORDERED = ["age", "limit_bal", "pay_1", "pay_2"]


@query("l3_isotonic", with_ctes(
    "gold",
    f"SELECT c AS feature, min(v) AS lo, max(v) AS hi, CAST(sum(n) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS pos, {rnd('rate', 8)} AS value FROM iso GROUP BY c, rate",
    pt="SELECT c, v, n, pos, CAST(sum(pos) OVER w AS DOUBLE) AS cp, CAST(sum(n) OVER w AS DOUBLE) AS cn FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS c, CAST({c} AS DOUBLE) AS v, count(*) AS n, CAST(sum(de_pay) AS BIGINT) AS pos FROM gold GROUP BY 2" for c in _ORDERED) + ") WINDOW w AS (PARTITION BY c ORDER BY v)",
    means="SELECT c, a.v AS f, b.v AS t, round((b.cp - a.cp + a.pos) / (b.cn - a.cn + a.n), 14) AS m FROM pt a JOIN pt b USING (c) WHERE a.v <= b.v",
    least_up="SELECT c, f, t, min(m) OVER (PARTITION BY c, f ORDER BY t DESC) AS m FROM means",
    iso="SELECT pt.c, pt.v, n, pos, max(m) AS rate FROM pt JOIN least_up l ON l.c = pt.c AND l.f <= pt.v AND l.t = pt.v GROUP BY 1, 2, 3, 4"))
def l3_isotonic(spark, d):
    """Steps of the default rate over features of the client."""
    rows = materialise(gold(spark, d))
    steps = [isotonic.isotonic_blocks(rows, LABEL, c).withColumn("feature", F.lit(c)) for c in _ORDERED]
    return nice(reduce(lambda a, b: a.unionByName(b), steps).select("feature", "lo", "hi", "n", "pos", "value"), {"value": 8})


@query("l3_calibrated", with_ctes(
    "scored",
    f"SELECT grp, count(*) AS n, {rnd('sum(CAST(label AS DOUBLE))', 6)} AS promised, true AS rising, true AS closer FROM scored GROUP BY grp"))
def l3_calibrated(spark, d):
    """The card score of each group, calibrated: it promises as many defaults as there are, rises with the score, and has the smaller Brier sum."""
    rows = materialise(scored(spark, d))
    found = None
    for grp in (1, 2, 3):
        own = rows.filter(F.col("grp") == grp)
        fitted = isotonic.calibrated(own, isotonic.isotonic_blocks(own, "label", "score"), "score")
        found = fitted if found is None else found.unionByName(fitted)
    order = F.lag("calibrated").over(Window.partitionBy("grp").orderBy("score"))
    table = found.groupBy("grp", "score", "calibrated").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    table = table.withColumn("falls", (F.coalesce(order, F.lit(0.0)) > F.col("calibrated") + 1e-12).cast("int"))

    def brier(p):  # of rows with the same score
        return F.sum(F.col("pos") * (1 - p) ** 2 + (F.col("n") - F.col("pos")) * p**2)

    out = table.groupBy("grp").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("calibrated")).alias("promised"), (F.sum("falls") == 0).alias("rising"),
        (brier(F.col("calibrated")) <= brier(F.col("score")) + 1e-9).alias("closer"),
    )
    return nice(out, {"promised": 6})


@query("l5_time_split", (
    "WITH days AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS k FROM orders GROUP BY 1), "
    "later AS (SELECT day, sum(k) OVER (ORDER BY day DESC) AS from_here, sum(k) OVER () AS total FROM days), "
    "cut AS (SELECT min(day) AS c FROM later WHERE from_here <= 0.3 * total) "
    "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) >= c THEN 'test' ELSE 'train' END AS split FROM orders, cut"))
def l5(spark, d):
    return risk.time_split(read_parquet(spark, d, "orders"), "o_orderdate").select("o_orderkey", "split")


@query("l6_lift", with_ctes(
    "",
    f"SELECT g AS lang, CAST(part AS INT) AS part, CAST(max(tp + fp) AS BIGINT) AS n_rows, {rnd('max(tp) / max(p)', 8)} AS gain, "
    f"{rnd('(max(tp) / max(p)) / (max(tp + fp) / max(p + n))', 8)} AS lift "
    "FROM (SELECT *, (10 * CAST(tp + fp AS BIGINT) + CAST(p + n AS BIGINT) - 1) // CAST(p + n AS BIGINT) AS part FROM run) GROUP BY 1, 2",
    **_curve_ctes("(SELECT lang, n_chars, quality FROM documents JOIN labels USING (doc_id))", "lang", "quality", "n_chars")))
def l6(spark, d):
    """Does the length of a document tell its quality?"""
    rows = documents_labelled(spark, d).filter("quality IS NOT NULL")
    return nice(risk.lift_table(rows, "quality", "n_chars", by=["lang"]), {"gain": 8, "lift": 8})
