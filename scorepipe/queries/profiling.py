"""Frequency tables, profiles, data quality, order and limits."""

from pyspark.sql import functions as F

from scorepipe.operators import metrics, profile, sampling
from scorepipe.operators.encode import fit_levels, level_map, one_hot
from scorepipe.plans import layers
from scorepipe.queries.base import (
    AMOUNTS, FEATURES, KEY, LABEL, NUMBERS, bronze, dbl, documents_labelled, gold, nice, query, rnd, scored, silver,
    unpivot_sql, with_ctes,
)
from scorepipe.queries.etl import DOCS
from scorepipe.sources.tables import preview, read_parquet


@query("d1_value_counts", with_ctes("silver", "SELECT pay_1 AS value, count(*) AS n FROM silver GROUP BY pay_1 ORDER BY value"))
def d1(spark, d):
    return profile.value_counts(silver(spark, d), "pay_1")


@query("d2_value_counts_by_count", "SELECT l_returnflag AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value")
def d2(spark, d):
    return profile.value_counts(read_parquet(spark, d, "lineitem"), "l_returnflag", by="count")


@query(
    "d3_null_profile",
    f"WITH t AS ({DOCS}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS nan_count FROM t"
        for c in ["doc_id", "lang", "n_chars", "quality", "toxic"]
    ),
)
def d3(spark, d):
    return profile.null_profile(documents_labelled(spark, d))


@query(
    "d3_null_columns",
    f"WITH t AS ({DOCS}), p AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS null_count, CAST(0 AS BIGINT) AS nan_count FROM t"
        for c in ["doc_id", "lang", "n_chars", "quality", "toxic"]
    )
    + ") SELECT * FROM p WHERE null_count > 0",
)
def d3_found(spark, d):
    return profile.null_profile(documents_labelled(spark, d), only_found=True)


@query("d4_row_count", "SELECT count(*) AS n FROM lineitem")
def d4(spark, d):
    return profile.row_count(read_parquet(spark, d, "lineitem"))


@query(
    "d5_count_parity",
    with_ctes(
        "gold",
        "SELECT b AS before_count, g AS after_count, b - g AS lost, b = g AS passed FROM n",
        n="SELECT (SELECT count(*) FROM clients) AS b, (SELECT count(*) FROM gold) AS g",
    ),
)
def d5(spark, d):
    return profile.count_parity(bronze(spark, d), gold(spark, d))


@query("d6_label_rate", with_ctes("silver", "SELECT " + rnd("avg(CASE WHEN de_pay = 1 THEN 1 ELSE 0 END)", 6) + " AS rate FROM silver"))
def d6(spark, d):
    return nice(profile.label_rate(silver(spark, d), LABEL), {"rate": 6})


@query(
    "d7_class_distribution",
    with_ctes(
        "gold",
        "SELECT de_pay AS label, count(*) AS n, " + rnd("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM gold)", 6)
        + " AS percentage FROM gold GROUP BY de_pay ORDER BY de_pay",
    ),
)
def d7(spark, d):
    return nice(profile.class_distribution(gold(spark, d), LABEL), {"percentage": 6})


@query(
    "d8_schema_delta",
    with_ctes(
        "silver",
        "SELECT 23 AS old_features, CAST(20 + levels AS INT) AS new_features, CAST(levels - 3 AS INT) AS added, "
        "(SELECT count(*) FROM silver) AS n FROM lv",
        lv="SELECT count(DISTINCT sex) + count(DISTINCT education) + count(DISTINCT marriage) AS levels FROM silver",
    ),
)
def d8(spark, d):
    """Feature counts of two layers, the second encoded with the levels found in the data."""
    before = silver(spark, d)
    after = one_hot(before, level_map(fit_levels(before, layers.CATEGORIES), layers.CATEGORIES))
    keys = (KEY, LABEL)
    return profile.schema_delta(before, after, keys, keys).withColumn("n", profile.row_count(after).scalar())


def _describe_sql(table: str, cols: list[str]) -> str:
    stats = {
        "count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})",
        "25%": "quantile_cont({c}, 0.25)", "50%": "quantile_cont({c}, 0.5)", "75%": "quantile_cont({c}, 0.75)",
        "max": "max({c})",
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{s}' AS stat, " + rnd(e.format(c=f"CAST({c} AS DOUBLE)"), 4) + f" AS value FROM {table}"
        for c in cols for s, e in stats.items()
    )


@query("d9_describe", _describe_sql("lineitem", AMOUNTS))
def d9(spark, d):
    return nice(profile.describe(read_parquet(spark, d, "lineitem"), AMOUNTS), {"value": 4})


@query("d9_describe_clients", with_ctes("silver", _describe_sql("silver", NUMBERS)))
def d9_clients(spark, d):
    return nice(profile.describe(silver(spark, d), NUMBERS), {"value": 4})


def _histogram_ctes(table: str, cols: list[str], bins: int) -> dict[str, str]:
    return {
        "long": unpivot_sql(table, cols),
        "mm": 'SELECT "column", min(value) AS a, max(value) AS b FROM long GROUP BY "column"',
        "rg": 'SELECT "column", CASE WHEN a = b THEN a - 0.5 ELSE a END AS mn, CASE WHEN a = b THEN b + 0.5 ELSE b END AS mx FROM mm',
        "edges": f'SELECT "column", CAST(r.range AS INT) AS bin, mn + r.range * ((mx - mn) / {bins}) AS lo, '
        f"CASE WHEN r.range = {bins - 1} THEN mx ELSE mn + (r.range + 1) * ((mx - mn) / {bins}) END AS hi "
        f"FROM rg, range({bins}) r",
    }


def _histogram_body(bins: int) -> str:
    return (
        'SELECT e."column", e.bin, ' + rnd("e.lo", 6) + " AS lo, " + rnd("e.hi", 6) + " AS hi, count(l.value) AS n "
        'FROM edges e LEFT JOIN long l ON l."column" = e."column" AND l.value >= e.lo '
        f"AND (l.value < e.hi OR (e.bin = {bins - 1} AND l.value <= e.hi)) GROUP BY ALL"
    )


@query("d10_histogram", with_ctes("silver", _histogram_body(30), **_histogram_ctes("silver", NUMBERS, 30)))
def d10(spark, d):
    return nice(profile.histogram(silver(spark, d), NUMBERS, 30), {"lo": 6, "hi": 6})


@query("d10_histogram_lineitem", with_ctes("", _histogram_body(10), **_histogram_ctes("lineitem", AMOUNTS, 10)))
def d10_lineitem(spark, d):
    return nice(profile.histogram(read_parquet(spark, d, "lineitem"), AMOUNTS, 10), {"lo": 6, "hi": 6})


def _corr_sql(table: str, cols: list[str]) -> str:
    def r(a, b):
        x, y = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
        flat = f"min({a}) = max({a}) OR min({b}) = max({b})"
        return f"CASE WHEN {flat} THEN NULL ELSE " + rnd(f"corr({x}, {y})", 6) + " END"

    cells = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {r(a, b)}}}" for a in cols for b in cols)
    return f"SELECT unnest([{cells}], recursive := true) FROM {table}"  # one pass over the table


@query("d11_corr_matrix", _corr_sql("lineitem", AMOUNTS))
def d11(spark, d):
    return nice(profile.corr_matrix(read_parquet(spark, d, "lineitem"), AMOUNTS), {"r": 6})


_CORR = [*FEATURES, LABEL]


@query("d11_corr_clients", with_ctes("gold", _corr_sql("gold", _CORR)))
def d11_clients(spark, d):
    return nice(profile.corr_matrix(gold(spark, d), _CORR), {"r": 6})


@query(
    "d12_cv_summary",
    with_ctes(
        "scored",
        "SELECT count(score) AS folds, " + rnd("avg(score)", 6) + " AS mean, " + rnd("stddev_pop(score)", 6)
        + " AS std_pop, " + rnd("var_samp(score)", 8) + " AS var_samp FROM f",
        k="SELECT label, pred, ntile(5) OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1 AS fold FROM scored",
        f="SELECT fold, avg(CAST(label = pred AS INT)) AS score FROM k GROUP BY fold",
    ),
)
def d12(spark, d):
    """Accuracy per fold of the card, summarised."""
    folds = sampling.kfold(scored(spark, d), KEY)
    out = profile.cv_summary(metrics.accuracy(folds, "label", "pred", ["fold"]), "accuracy")
    return nice(out, {"mean": 6, "std_pop": 6, "var_samp": 8})


@query("d13_distinct", "SELECT DISTINCT l_linenumber AS value FROM lineitem")
def d13(spark, d):
    return profile.distinct_values(read_parquet(spark, d, "lineitem"), "l_linenumber")


_GOLD_COLS = [KEY, *NUMBERS, LABEL, *[c for c in FEATURES if c not in NUMBERS]]


@query(
    "d14_dq_report",
    with_ctes(
        "gold",
        " UNION ALL ".join(
            f"SELECT 'null_count' AS \"check\", '{c}' AS \"column\", CAST(count(*) - count({c}) AS DOUBLE) AS value, "
            f"count(*) = count({c}) AS passed FROM gold" for c in _GOLD_COLS
        )
        + " UNION ALL SELECT 'row_count', NULL, CAST(g AS DOUBLE), g = b FROM n"
        + " UNION ALL SELECT 'parent_row_count', NULL, CAST(b AS DOUBLE), true FROM n"
        + " UNION ALL SELECT 'lost_rows', NULL, CAST(b - g AS DOUBLE), b = g FROM n"
        + " UNION ALL SELECT 'positive_rate', 'de_pay', " + rnd("avg(CASE WHEN de_pay = 1 THEN 1 ELSE 0 END)", 6) + ", true FROM gold",
        n="SELECT (SELECT count(*) FROM clients) AS b, (SELECT count(*) FROM gold) AS g",
    ),
)
def d14(spark, d):
    return nice(profile.dq_report(gold(spark, d), bronze(spark, d), LABEL), {"value": 6})


@query("s1_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice")
def s1(spark, d):
    return read_parquet(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice")


@query("s2_first_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def s2(spark, d):
    return preview(read_parquet(spark, d, "orders"), 20, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("s3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def s3(spark, d):
    return profile.top_k(read_parquet(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 15, "o_orderkey")


@query(
    "s3_top_k_per_group",
    "SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) t WHERE rank <= 3",
)
def s3_group(spark, d):
    orders = read_parquet(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return profile.top_k(orders, "o_totalprice", 3, "o_orderkey", ["o_orderpriority"])
