"""Sources, cleaning, encoding."""

import uuid

from pyspark.sql import functions as F

from scorepipe.functions.columns import rounded
from scorepipe.operators import clean, encode, profile, sampling
from scorepipe.plans import layers
from scorepipe.plans.layers import layer_registry
from scorepipe.queries.base import (
    BILLS, DELAYS, FEATURES, KEY, LABEL, NUMBERS, PAYS, RAW_DELAYS, SPLIT_SQL, bronze, documents_labelled, gold, nice,
    query, rnd, silver, unpivot_sql, with_ctes,
)
from scorepipe.session import work_path
from scorepipe.sources.tables import preview, query as run_sql, read_parquet, read_table, register_folder

DOCS = "SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"


@query("a1_read_table", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def a1(spark, d):
    register_folder(spark, d, ["customer"], prefix="src_")
    return read_table(spark, "src_customer")


@query("a2_sql_select", "SELECT * FROM orders")
def a2(spark, d):
    return run_sql(spark, "SELECT * FROM {t}", t=read_parquet(spark, d, "orders"))


@query("a5_dataset_refresh", with_ctes("gold", "SELECT * FROM gold"))
def a5(spark, d):
    bronze(spark, d).createOrReplaceTempView("src_clients")
    reg = layer_registry(spark, "src_clients", layers.LEVELS)
    return reg.refresh(["client_gold"], as_tables=False)["client_gold"]


_CHECKS = {
    "silver": {
        **{f"{c} known": f"{c} IN ({', '.join(map(str, v))})" for c, v in layers.LEVELS.items()},
        "key present": "id IS NOT NULL", "delays from zero up": " AND ".join(f"{c} >= 0" for c in DELAYS),
    },
    "gold": {"label 0 or 1": "de_pay IN (0, 1)", "older than 25": "age > 25"},
}


@query("a5_refreshed_tables", with_ctes("gold", " UNION ALL ".join(
    f"SELECT '{layer}' AS dataset, '{name}' AS \"check\", count(*) AS rows, count(*) FILTER (NOT coalesce({cond}, false)) AS failed FROM {layer}"
    for layer, checks in _CHECKS.items() for name, cond in checks.items()) + " UNION ALL SELECT 'gold', 'as built', count(*), 0 FROM gold"))
def a5_tables(spark, d):
    """The layers written as tables in order; rows and failed checks are counted before a table takes its name."""
    prefix = f"a5_{uuid.uuid4().hex[:12]}"
    bronze(spark, d).createOrReplaceTempView("src_clients")
    reg = layer_registry(spark, "src_clients", layers.LEVELS, prefix, work_path(spark, "datasets"))
    table = reg.refresh()[f"{prefix}_gold"]
    other = table.exceptAll(gold(spark, d)).count()  # the table against the frame that was never written
    built = table.agg(F.lit("gold").alias("dataset"), F.lit("as built").alias("check"), F.count(F.lit(1)).alias("rows"), F.lit(other).cast("bigint").alias("failed"))
    return reg.report().withColumn("dataset", F.regexp_replace("dataset", f"^{prefix}_", "")).unionByName(built)


@query("a7_preview", with_ctes("clients", "SELECT * FROM clients ORDER BY id LIMIT 5"))
def a7(spark, d):
    return preview(bronze(spark, d), 5, KEY)


@query("b1_rename", with_ctes("clients", "SELECT id, pay_0 AS pay_1, default_next AS de_pay FROM clients"))
def b1(spark, d):
    return clean.rename_map(bronze(spark, d), layers.RENAMES).select(KEY, "pay_1", LABEL)


@query(
    "b2_recode_set",
    with_ctes("clients", "SELECT id, CASE WHEN education IN (0, 5, 6) THEN 4 ELSE education END AS education FROM clients"),
)
def b2(spark, d):
    return clean.recode(bronze(spark, d), "education", layers.EDUCATION_CODES).select(KEY, "education")


@query(
    "b3_recode_value",
    with_ctes("clients", "SELECT id, CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage FROM clients"),
)
def b3(spark, d):
    return clean.recode(bronze(spark, d), "marriage", layers.MARRIAGE_CODES).select(KEY, "marriage")


@query(
    "b4_recode_many",
    with_ctes("clients", "SELECT id, " + ", ".join(f"CASE WHEN {c} <= 0 AND {c} >= -2 THEN 0 ELSE {c} END AS {c}" for c in RAW_DELAYS) + " FROM clients"),
)
def b4(spark, d):
    return clean.recode_many(bronze(spark, d), RAW_DELAYS, layers.DELAY_CODES).select(KEY, *RAW_DELAYS)


@query("b_clean_layer", with_ctes("silver", "SELECT * FROM silver"))
def b_clean(spark, d):
    return silver(spark, d)


@query(
    "b5_drop_columns",
    with_ctes("silver", "SELECT " + ", ".join(["limit_bal", "age", *DELAYS, *BILLS, *PAYS, LABEL]) + " FROM silver"),
)
def b5(spark, d):
    return clean.drop_columns(silver(spark, d), KEY, *layers.CATEGORIES)


@query("b6_split_xy", with_ctes("gold", "SELECT id, " + ", ".join(FEATURES) + " FROM gold"))
def b6(spark, d):
    return clean.split_xy(gold(spark, d), LABEL, KEY)[0]


@query("b6_target", with_ctes("gold", "SELECT id, de_pay FROM gold"))
def b6_target(spark, d):
    return clean.split_xy(gold(spark, d), LABEL, KEY)[1]


@query("b7_where_equals", with_ctes("silver", "SELECT id, limit_bal, de_pay FROM silver WHERE de_pay = 1"))
def b7(spark, d):
    return clean.where_equals(silver(spark, d), LABEL, 1).select(KEY, "limit_bal", LABEL)


@query("b8_where_in", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'P'")
def b8(spark, d):
    orders = read_parquet(spark, d, "orders")
    hit = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | (F.col("o_orderstatus") == "P")
    return orders.filter(hit).select("o_orderkey", "o_orderpriority")


@query(
    "b9_null_flags",
    f"WITH t AS ({DOCS}) SELECT doc_id, CAST(quality IS NULL AS int) AS quality_is_null, "
    "CAST(lang IS NULL AS int) AS lang_is_null FROM t",
)
def b9(spark, d):
    flagged = clean.null_flags(documents_labelled(spark, d), ["quality", "lang"])
    return flagged.select("doc_id", "quality_is_null", "lang_is_null")


@query(
    "b10_percentage",
    "SELECT event_type, count(*) AS n, "
    + rnd("count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM events)", 6) + " AS percentage FROM events GROUP BY event_type",
)
def b10(spark, d):
    out = profile.class_distribution(read_parquet(spark, d, "events").select("event_type"), "event_type")
    return out.select(F.col("label").alias("event_type"), "n", rounded(F.col("percentage"), 6).alias("percentage"))


@query("b11_drop_nulls", f"WITH t AS ({DOCS}) SELECT * FROM t WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def b11(spark, d):
    return clean.drop_nulls(documents_labelled(spark, d), ["quality", "toxic"])


@query(
    "c1_fit_levels",
    with_ctes("silver", " UNION ".join(f"SELECT '{c}' AS \"column\", {c} AS level FROM silver" for c in layers.CATEGORIES)),
)
def c1(spark, d):
    return encode.fit_levels(silver(spark, d), layers.CATEGORIES)


@query("c2_one_hot", with_ctes("gold", "SELECT * FROM gold"))
def c2(spark, d):
    """Levels discovered from the data, then the pure transform."""
    return layers.features(silver(spark, d))


_STATUS = ["F", "O", "P"]
_PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "c3_dummies",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\""
        for c, vs in (("o_orderstatus", _STATUS), ("o_orderpriority", _PRIORITY)) for v in vs
    )
    + " FROM orders",
)
def c3(spark, d):
    orders = read_parquet(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    cols = ["o_orderstatus", "o_orderpriority"]
    return encode.one_hot(orders, encode.fit_levels(orders, cols, as_int=False), cols)


@query(
    "g1_fit_scaler",
    with_ctes(
        "gold",
        'SELECT "column", ' + rnd("avg(value)", 4) + " AS mean, " + rnd("stddev_pop(value)", 4)
        + ' AS std_pop FROM long GROUP BY "column"',
        long=unpivot_sql("gold", FEATURES),
    ),
)
def g1_fit(spark, d):
    return nice(encode.fit_scaler(gold(spark, d), FEATURES), {"mean": 4, "std_pop": 4})


_SCALED = NUMBERS


@query(
    "g1_scale",
    with_ctes(
        "gold",
        "SELECT id, split, "
        + ", ".join(rnd(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END", 6) + f" AS {c}" for c in _SCALED)
        + " FROM parts, stats",
        parts=SPLIT_SQL.format(src="gold"),
        stats="SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
        + " FROM parts WHERE split = 'train'",
    ),
)
def g1_scale(spark, d):
    """Fitted on the training part, applied to both."""
    parts = sampling.stratified_split(gold(spark, d), LABEL, KEY)
    stats = encode.fit_scaler(parts.filter(F.col("split") == "train"), _SCALED)
    return nice(encode.scale(parts, stats).select(KEY, "split", *_SCALED), {c: 6 for c in _SCALED})
