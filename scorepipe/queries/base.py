"""Query registry, shared inputs, and the SQL building blocks of their counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.functions.columns import rounded
from scorepipe.operators.models import score_linear
from scorepipe.operators.metrics import predict_label
from scorepipe.plans import layers
from scorepipe.sources.clients import clients
from scorepipe.sources.tables import read_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEY, LABEL = layers.KEY, layers.LABEL
BILLS = [f"bill_amt{m}" for m in range(1, 7)]
PAYS = [f"pay_amt{m}" for m in range(1, 7)]
DELAYS = layers.DELAYS
RAW_DELAYS = ["pay_0", *DELAYS[1:]]
FLAGS = [f"{c}_{v}" for c, values in layers.LEVELS.items() for v in values]
NUMBERS = ["limit_bal", "age", *DELAYS, *BILLS, *PAYS]
FEATURES = [*NUMBERS, *FLAGS]
AMOUNTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# A hand-set scorecard and a second one to compare it with.
CARD = {"pay_1": 0.8, "pay_2": 0.25, "limit_bal": -0.00005, "age": 0.004, "education_2": 0.1, "sex_1": 0.05}
CARD_INTERCEPT = -1.4
SECOND_CARD = {"pay_1": 0.5, "pay_3": 0.3, "limit_bal": -0.00008, "marriage_1": 0.1}
SECOND_INTERCEPT = -0.9


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL counterpart when SQL can express it."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- inputs ---------------------------------------------------------------------------------------


def bronze(spark: SparkSession, d: str) -> DataFrame:
    return clients(spark, d)


def silver(spark: SparkSession, d: str) -> DataFrame:
    return layers.clean(bronze(spark, d))


def gold(spark: SparkSession, d: str) -> DataFrame:
    return layers.features(silver(spark, d), layers.LEVELS)


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Gold rows with label, card score, hard label and the marriage code as a group."""
    g = score_linear(gold(spark, d), CARD, CARD_INTERCEPT)
    grp = F.when(F.col("marriage_1") == 1, 1).when(F.col("marriage_2") == 1, 2).otherwise(3)
    return predict_label(g.withColumn("label", F.col(LABEL)).withColumn("grp", grp))


def lineitem_scored(spark: SparkSession, d: str) -> DataFrame:
    return read_parquet(spark, d, "lineitem").select(
        "l_linestatus", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label")
    )


def events_scored(spark: SparkSession, d: str) -> DataFrame:
    return read_parquet(spark, d, "events").select(
        "event_id", "value", (F.col("event_type") == "purchase").cast("int").alias("label")
    )


def documents_scored(spark: SparkSession, d: str) -> DataFrame:
    docs = read_parquet(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(read_parquet(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id")


def documents_labelled(spark: SparkSession, d: str) -> DataFrame:
    """All documents; those without labels carry NULLs."""
    docs = read_parquet(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(read_parquet(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")


def nice(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Rounded doubles in place, other columns untouched."""
    return df.select(*[rounded(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


# --- SQL building blocks --------------------------------------------------------------------------


def dbl(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def margin_sql(weights: dict[str, float], intercept: float) -> str:
    return " + ".join([dbl(intercept), *[f"{dbl(w)} * CAST({c} AS DOUBLE)" for c, w in weights.items()]])


def rnd(expr: str, digits: int) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE)"


def hash_int_sql(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _months(expr: str, names: list[str]) -> str:
    return ", ".join(expr.format(m=i + 1) + f" AS {n}" for i, n in enumerate(names))


_CTE = {
    "o": (
        "SELECT o_custkey AS k, CAST(least(6, year(o_orderdate) - 1994) AS int) AS b, "
        "o_totalprice AS p, o_orderstatus AS st FROM orders"
    ),
    "a": (
        "SELECT k, "
        + _months("round(sum(CASE WHEN b={m} THEN p ELSE 0 END), 2)", BILLS) + ", "
        + _months("round(sum(CASE WHEN b={m} AND st='F' THEN p ELSE 0 END), 2)", PAYS) + ", "
        + _months("CAST(least(8, sum(CASE WHEN b={m} THEN 1 ELSE 0 END) - 2) AS int)", RAW_DELAYS)
        + " FROM o GROUP BY k"
    ),
    "clients": (
        "SELECT c_custkey AS id, c_acctbal AS limit_bal, CAST(1 + c_custkey % 2 AS int) AS sex, "
        "CAST(c_custkey % 7 AS int) AS education, CAST(c_nationkey % 4 AS int) AS marriage, "
        "CAST(21 + c_custkey % 50 AS int) AS age, " + ", ".join([*RAW_DELAYS, *BILLS, *PAYS]) + ", "
        "CASE WHEN pay_0 >= 1 AND (c_custkey*7 + c_nationkey*3) % 10 < 6 THEN 1 "
        "WHEN pay_0 < 1 AND (c_custkey*7 + c_nationkey*3) % 10 < 1 THEN 1 ELSE 0 END AS default_next "
        "FROM customer JOIN a ON c_custkey = a.k"
    ),
    "silver": (
        "SELECT id, limit_bal, sex, CASE WHEN education IN (0, 5, 6) THEN 4 ELSE education END AS education, "
        "CASE WHEN marriage = 0 THEN 3 ELSE marriage END AS marriage, age, "
        + ", ".join(
            f"CASE WHEN {r} IN (-2, -1, 0) THEN 0 ELSE {r} END AS {n}" for r, n in zip(RAW_DELAYS, DELAYS)
        )
        + ", " + ", ".join([*BILLS, *PAYS]) + ", default_next AS de_pay FROM clients"
    ),
    "gold": (
        "SELECT id, " + ", ".join(NUMBERS) + ", de_pay, "
        + ", ".join(
            f"CASE WHEN {c} = {v} THEN 1 ELSE 0 END AS {c}_{v}" for c, vs in layers.LEVELS.items() for v in vs
        )
        + " FROM silver"
    ),
    "margins": f"SELECT *, {margin_sql(CARD, CARD_INTERCEPT)} AS margin FROM gold",
    "probs": f"SELECT *, {dbl(1.0)} / ({dbl(1.0)} + exp(-margin)) AS score FROM margins",
    "scored": (
        "SELECT *, de_pay AS label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS pred, "
        "CASE WHEN marriage_1 = 1 THEN 1 WHEN marriage_2 = 1 THEN 2 ELSE 3 END AS grp FROM probs"
    ),
}
_CHAIN = ["o", "a", "clients", "silver", "gold", "margins", "probs", "scored"]


def with_ctes(upto: str, body: str, **extra: str) -> str:
    """`body` after the common table expressions up to one of them, then extra ones in order."""
    chain = [(n, _CTE[n]) for n in _CHAIN[: _CHAIN.index(upto) + 1]] if upto else []
    chain += list(extra.items())
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in chain) + " " + body


def unpivot_sql(table: str, cols: list[str], keep: str = "") -> str:
    """Columns to rows, as one SELECT per column."""
    lead = keep + ", " if keep else ""
    return " UNION ALL ".join(f"SELECT {lead}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {table}" for c in cols)


SPLIT_SQL = (
    "SELECT *, CASE WHEN row_number() OVER (PARTITION BY de_pay ORDER BY md5('100:' || CAST(id AS VARCHAR)), id) "
    "<= floor(0.3 * count(*) OVER (PARTITION BY de_pay) + 0.5) THEN 'test' ELSE 'train' END AS split FROM {src}"
)
