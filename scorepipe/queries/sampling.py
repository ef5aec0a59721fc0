"""Joins by key, splits, folds, class balancing."""

from pyspark.sql import functions as F

from scorepipe.operators import clean, neighbors, sampling
from scorepipe.queries.base import (
    FEATURES, KEY, LABEL, NUMBERS, SPLIT_SQL, gold, hash_int_sql, nice, query, rnd, silver, with_ctes,
)
from scorepipe.sources.tables import materialise, read_parquet

_FOLDS = "SELECT *, CAST(ntile(5) OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) - 1 AS INT) AS fold FROM silver"


@query("e1_join_on_id", with_ctes("gold", "SELECT id, " + ", ".join(FEATURES) + ", de_pay FROM gold"))
def e1(spark, d):
    x, y = clean.split_xy(gold(spark, d), LABEL, KEY)
    return sampling.join_on_id(x, y, KEY)


@query("e2_union", with_ctes("silver", "SELECT * FROM silver WHERE de_pay IS NOT NULL"))
def e2(spark, d):
    s = silver(spark, d)
    return sampling.union_bags(clean.where_equals(s, LABEL, 0), clean.where_equals(s, LABEL, 1))


@query("f1_stratified_split", with_ctes("silver", "SELECT * FROM parts", parts=SPLIT_SQL.format(src="silver")))
def f1(spark, d):
    return sampling.stratified_split(silver(spark, d), LABEL, KEY)


@query(
    "f1_split_orders",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY "
    "md5('100:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= floor(0.3 * count(*) OVER (PARTITION BY o_orderstatus) + 0.5) "
    "THEN 'test' ELSE 'train' END AS split FROM orders",
)
def f1_orders(spark, d):
    orders = read_parquet(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(orders, "o_orderstatus", "o_orderkey")


@query(
    "f2_oversample",
    with_ctes(
        "silver",
        "SELECT *, CAST(-1 AS BIGINT) AS draw FROM silver WHERE de_pay = 0 UNION ALL "
        "SELECT i.* EXCLUDE (idx), dr.draw FROM dr JOIN ix i ON i.idx = dr.idx",
        ix="SELECT *, row_number() OVER (ORDER BY md5('42:row:' || CAST(id AS VARCHAR)), id) - 1 AS idx "
        "FROM silver WHERE de_pay = 1",
        dr="SELECT range AS draw, " + hash_int_sql("'42:draw:' || CAST(range AS VARCHAR)")
        + " % (SELECT count(*) FROM silver WHERE de_pay = 1) AS idx "
        "FROM range((SELECT count(*) FROM silver WHERE de_pay = 0))",
    ),
)
def f2(spark, d):
    out = sampling.oversample(silver(spark, d), LABEL, KEY)
    return out.withColumn("draw", F.coalesce("draw", F.lit(-1).cast("bigint")))


_INTS = [c for c in FEATURES if not c.startswith(("limit_bal", "bill_amt", "pay_amt"))]


def _mixed(c: str) -> str:
    value = f"x.{c} + u * (y.{c} - x.{c})"
    if c in _INTS:
        return f"CAST(trunc({value}) AS INT) AS {c}"
    return rnd(value, 4) + f" AS {c}"


_DIST = " + ".join(f"CAST(p.{c} - q.{c} AS DOUBLE) * CAST(p.{c} - q.{c} AS DOUBLE)" for c in FEATURES)


@query(
    "f3_smote",
    with_ctes(
        "gold",
        "SELECT id, CAST(-1 AS BIGINT) AS draw, "
        + ", ".join(c if c in _INTS else rnd(c, 4) + f" AS {c}" for c in FEATURES)
        + ", de_pay FROM gold UNION ALL SELECT CAST(-1 AS BIGINT), dr.draw, "
        + ", ".join(_mixed(c) for c in FEATURES)
        + ", 1 FROM dr JOIN ix ON ix.idx = dr.idx JOIN nn ON nn.id = ix.id AND nn.rk = dr.rk "
        "JOIN mi x ON x.id = nn.id JOIN mi y ON y.id = nn.nb",
        mi="SELECT * FROM gold WHERE de_pay = 1",
        ix="SELECT id, row_number() OVER (ORDER BY md5('100:row:' || CAST(id AS VARCHAR)), id) - 1 AS idx FROM mi",
        nn="SELECT id, nb, rk FROM (SELECT p.id, q.id AS nb, row_number() OVER (PARTITION BY p.id ORDER BY "
        + _DIST + ", q.id) AS rk FROM mi p JOIN mi q ON p.id <> q.id) t WHERE rk <= 5",
        dr="SELECT range AS draw, " + hash_int_sql("'100:base:' || CAST(range AS VARCHAR)")
        + " % (SELECT count(*) FROM mi) AS idx, " + hash_int_sql("'100:near:' || CAST(range AS VARCHAR)") + " % 5 + 1 AS rk, "
        + hash_int_sql("'100:gap:' || CAST(range AS VARCHAR)") + " / CAST(1152921504606846976 AS DOUBLE) AS u "
        "FROM range((SELECT count(*) FILTER (de_pay = 0) - count(*) FILTER (de_pay = 1) FROM gold))",
    ),
)
def f3(spark, d):
    out = sampling.smote(materialise(gold(spark, d)), LABEL, KEY, FEATURES)
    out = nice(out, {c: 4 for c in FEATURES if c not in _INTS})
    none = F.lit(-1).cast("bigint")
    return out.withColumn(KEY, F.coalesce(KEY, none)).withColumn("draw", F.coalesce("draw", none))


_DIMS = 64


@query(
    "f3_nearest_neighbors",
    "WITH v AS (SELECT vec_id AS id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(_DIMS))
    + " FROM embeddings), t AS (SELECT p.id, q.id AS neighbor, "
    + " + ".join(f"(p.f{i} - q.f{i}) * (p.f{i} - q.f{i})" for i in range(_DIMS))
    + " AS dist2 FROM v p JOIN v q ON p.id <> q.id), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY dist2, neighbor) AS rank FROM t) "
    "SELECT id, neighbor, " + rnd("dist2", 6) + " AS dist2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5",
)
def f3_neighbors(spark, d):
    """Five nearest vectors of every vector."""
    e = read_parquet(spark, d, "embeddings").select(
        "vec_id", *[F.element_at("embedding", i + 1).cast("double").alias(f"f{i}") for i in range(_DIMS)]
    )
    return nice(neighbors.nearest_neighbors(e, "vec_id", [f"f{i}" for i in range(_DIMS)]), {"dist2": 6})


@query("f4_kfold", with_ctes("silver", _FOLDS))
def f4(spark, d):
    return sampling.kfold(silver(spark, d), KEY)


@query(
    "f4_kfold_orders",
    "SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS INT) AS fold FROM orders",
)
def f4_orders(spark, d):
    return sampling.kfold(read_parquet(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "f5_stratified_kfold",
    with_ctes(
        "silver",
        # class order by first id; the class's share of fold i are the end-to-end places congruent to i
        "SELECT silver.*, f.fold FROM silver JOIN (SELECT r.id, CAST(min(s.fold) AS INT) AS fold FROM r JOIN s ON s.de_pay = r.de_pay AND r.rn <= s.upto GROUP BY r.id) f USING (id)",
        c="SELECT de_pay, count(*) AS n, min(id) AS first FROM silver GROUP BY de_pay",
        st="SELECT de_pay, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM c",
        places="SELECT st.de_pay, (start + p.range) % 5 AS fold FROM st JOIN range((SELECT max(n) FROM st)) p ON p.range < st.n",
        held="SELECT de_pay, fold, count(*) AS n FROM places GROUP BY de_pay, fold",
        s="SELECT de_pay, fold, sum(n) OVER (PARTITION BY de_pay ORDER BY fold) AS upto FROM held",
        r="SELECT id, de_pay, row_number() OVER (PARTITION BY de_pay ORDER BY id) AS rn FROM silver",
    ),
)
def f5(spark, d):
    return sampling.stratified_kfold(silver(spark, d), LABEL, KEY)


@query("f6_fold_frames", with_ctes("silver", "SELECT *, CASE WHEN fold = 0 THEN 'valid' ELSE 'train' END AS part FROM f", f=_FOLDS))
def f6(spark, d):
    folds = sampling.kfold(silver(spark, d), KEY)
    train, valid = sampling.fold_frames(folds, 0)
    return sampling.union_bags(train.withColumn("part", F.lit("train")), valid.withColumn("part", F.lit("valid")))


@query("f8_class_weight", with_ctes("silver", "SELECT *, CAST(CASE WHEN de_pay = 1 THEN 3 ELSE 1 END AS DOUBLE) AS weight FROM silver"))
def f8(spark, d):
    return sampling.class_weight(silver(spark, d), LABEL, 3)
