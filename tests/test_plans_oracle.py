"""Registered queries against SQL, and the shape of their physical plans."""

import re

import pytest
from conftest import MEDIUM, SMALL
from oracle import compare, duck
from pyspark.sql import functions as F

from scorepipe.operators import metrics, sampling
from scorepipe.queries import ORACLES, QUERIES
from scorepipe.queries.base import lineitem_scored
from scorepipe.sources.tables import read_parquet


@pytest.fixture(scope="module")
def con():
    c = duck(SMALL)
    yield c
    c.close()


#: Many fits at the published settings; the driver compares them with SQL, here their parts have tests of their own.
MANY_FITS = {"f7_strategy_sweep", "g7_cv_boosted", "g8_random_search", "g10_train_evaluate"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - MANY_FITS))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SMALL) == ""


def test_every_other_query_is_a_model_query():
    rest = set(QUERIES) - set(ORACLES)
    assert rest == {
        "g2_logistic", "i2_base_value", "i3_explain_tree_row", "i6_gain_importance", "i7_gain_against_shap",
    }


def test_golden_discrimination(spark):
    # Known results of the simple score on the fixture tables.
    want = {SMALL: (0.635069, 0.270137, 0.417249), MEDIUM: (0.740715, 0.481429, 0.473983)}
    for folder, (auc, gini, ks) in want.items():
        r = QUERIES["flagship_discrimination"](spark, folder).first()
        assert (r["auc"], r["gini"], r["ks_roc"], r["ks_2samp"]) == (auc, gini, ks, ks)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_used(spark):
    text = plan(metrics.rank_metrics(lineitem_scored(spark, SMALL), "label", "l_extendedprice", ["l_linestatus"]))
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert {c.split(":")[0] for c in schema.split(",")} <= {"l_extendedprice", "l_returnflag", "l_linestatus"}


def test_row_sized_shuffles_are_spread(spark):
    """Grouped metrics have no single-partition exchange before the last, per-group step."""
    text = plan(metrics.rank_metrics(lineitem_scored(spark, SMALL), "label", "l_extendedprice", ["l_linestatus"]))
    assert "SinglePartition" not in text


def test_filter_reaches_the_scan(spark):
    orders = read_parquet(spark, SMALL, "orders").filter(F.col("o_orderstatus") == "P").select("o_orderkey")
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in plan(orders)


def test_top_k_per_group_limits_before_the_shuffle(spark):
    assert plan(QUERIES["s3_top_k_per_group"](spark, SMALL)).count("WindowGroupLimit") == 2


def test_fold_assignment_is_a_projection(spark):
    out = sampling.kfold(read_parquet(spark, SMALL, "orders").select("o_orderkey"), "o_orderkey")
    assert "Exchange" not in plan(out)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["n_pos", "n_neg", "auc", "gini", "ks_roc", "ks_2samp"]
    assert set(e.oracle_sql()) <= set(e.queries())
