"""Client table of the scoring workflow, derived from customers and their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.sources.tables import read_parquet

MONTHS = (1, 2, 3, 4, 5, 6)
LABEL_RAW = "default_next"


def clients(spark: SparkSession, folder: str) -> DataFrame:
    """Raw layer: one row per customer with orders, six periods of amounts and delays.

    Orders are reduced to one row per customer before the join, so a customer with very many
    orders costs partial sums, not a wide shuffle.
    """
    orders = read_parquet(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"),
        F.least(F.lit(6), F.year("o_orderdate") - 1994).alias("b"),
        F.col("o_totalprice").alias("p"),
        (F.col("o_orderstatus") == "F").alias("paid"),
    )

    def amount(cond):
        return F.round(F.sum(F.when(cond, F.col("p")).otherwise(F.lit(0.0).cast("double"))), 2)

    def delay(m):
        seen = F.sum(F.when(F.col("b") == m, 1).otherwise(0))
        return F.least(F.lit(8), seen - 2).cast("int")

    per_client = orders.groupBy("k").agg(
        *[amount(F.col("b") == m).alias(f"bill_amt{m}") for m in MONTHS],
        *[amount((F.col("b") == m) & F.col("paid")).alias(f"pay_amt{m}") for m in MONTHS],
        *[delay(m).alias("pay_0" if m == 1 else f"pay_{m}") for m in MONTHS],
    )
    c = read_parquet(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    risk = (F.col("c_custkey") * 7 + F.col("c_nationkey") * 3) % 10
    late = F.col("pay_0") >= 1
    return c.join(per_client, c.c_custkey == per_client.k).select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("limit_bal"),
        (1 + F.col("c_custkey") % 2).cast("int").alias("sex"),
        (F.col("c_custkey") % 7).cast("int").alias("education"),
        (F.col("c_nationkey") % 4).cast("int").alias("marriage"),
        (21 + F.col("c_custkey") % 50).cast("int").alias("age"),
        "pay_0",
        *[f"pay_{m}" for m in MONTHS[1:]],
        *[f"bill_amt{m}" for m in MONTHS],
        *[f"pay_amt{m}" for m in MONTHS],
        F.when(late & (risk < 6), 1).when(~late & (risk < 1), 1).otherwise(0).alias(LABEL_RAW),
    )
