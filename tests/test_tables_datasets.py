import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorepipe.plans import layers
from scorepipe.plans.datasets import Registry
from scorepipe.sources import tables


def test_table_names():
    assert tables.table_name("t") == "t"
    assert tables.table_name("t", "s", "c") == "c.s.t"
    assert tables.table_name("s.t", "x", "c") == "c.s.t"
    assert tables.table_name("c.s.t", "x", "y") == "c.s.t"
    with pytest.raises(ValueError):
        tables.table_name("a..b")


def test_csv(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("ID,LIMIT_BAL,default.payment.next.month\n1,20000.5,1\n2,,0\n")
    schema = T.StructType([
        T.StructField("ID", T.LongType()), T.StructField("LIMIT_BAL", T.DoubleType()),
        T.StructField("default.payment.next.month", T.IntegerType()),
    ])
    fixed, guessed = tables.read_csv(spark, str(p), schema), tables.read_csv(spark, str(p))
    assert rows(fixed) == [(1, 20000.5, 1), (2, None, 0)] == rows(guessed)
    assert fixed.schema == schema


def test_write_table_replaces_itself(spark):
    df = spark.range(5).withColumn("x", F.lit(1))
    tables.write_table(df, "t_replace", comment="five rows")
    tables.write_table(tables.read_table(spark, "t_replace").withColumn("x", F.col("x") + 1), "t_replace")
    assert rows(spark.table("t_replace"), "x") == [(2,)] * 5
    tables.write_table(spark.range(3), "t_replace")
    assert spark.table("t_replace").columns == ["id"] and spark.table("t_replace").count() == 3
    with pytest.raises(ValueError):
        tables.write_table(df, "t_replace", overwrite_schema=False)
    names = {t.name for t in spark.catalog.listTables()}
    assert not [n for n in names if n.startswith("t_replace__")]
    assert tables.table_location(spark, "t_replace").startswith("file:")


def test_failed_write_keeps_the_table(spark):
    tables.write_table(spark.range(4), "t_keep")
    bad = spark.range(4).withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception):
        tables.write_table(bad, "t_keep")
    assert spark.table("t_keep").count() == 4


def test_preview_shape_schema(spark):
    df = spark.range(9)
    assert rows(tables.preview(df, 2, F.desc("id"))) == [(7,), (8,)]
    assert tuple(tables.shape(df).first()) == (9, 1)
    assert rows(tables.schema_rows(df)) == [(0, "id", "bigint")]
    assert rows(tables.query(spark, "SELECT count(*) AS n FROM {t}", t=df)) == [(9,)]


def test_registry_order_and_refresh(spark):
    reg, seen = Registry(spark), []
    spark.range(6).createOrReplaceTempView("ds_raw")

    @reg.dataset("ds_b", "doubled", inputs=["ds_a"])
    def b(a):
        seen.append("b")
        return a.select((F.col("id") * 2).alias("id"))

    @reg.dataset("ds_a", "filtered", inputs=["ds_raw"])
    def a(raw):
        seen.append("a")
        return raw.filter("id > 2")

    built = reg.refresh()
    assert seen == ["a", "b"] and sorted(r["id"] for r in built["ds_b"].collect()) == [6, 8, 10]
    reg.refresh(["ds_b"])
    assert sorted(r["id"] for r in spark.table("ds_b").collect()) == [6, 8, 10]
    assert reg.order(["ds_a"]) == ["ds_a"]
    with pytest.raises(KeyError):
        reg.refresh(["nope"])
    with pytest.raises(ValueError):
        reg.dataset("ds_a")(a)


def test_layers_as_tables(spark, gold):
    from conftest import MEDIUM
    from scorepipe.queries.base import bronze

    bronze(spark, MEDIUM).createOrReplaceTempView("lay_raw")
    reg = layers.layer_registry(spark, "lay_raw", prefix="lay")
    out = reg.refresh()
    assert out["lay_gold"].columns == gold.columns
    assert out["lay_gold"].exceptAll(gold).count() == 0


def test_refresh_counts_rows_and_failed_checks(spark, tmp_path):
    reg = Registry(spark, str(tmp_path / "tables"))
    spark.range(10).createOrReplaceTempView("chk_raw")
    reg.dataset("chk_a", "some", ["chk_raw"], {"small": F.col("id") < 8, "even": F.when(F.col("id") != 3, F.col("id") % 2 == 0)})(lambda raw: raw.filter("id > 0"))
    reg.dataset("chk_b", "all", ["chk_a"], {"kept": F.col("id") > 0})(lambda a: a)
    built = reg.refresh()
    assert sorted(map(tuple, reg.report().collect())) == [("chk_a", "even", 9, 5), ("chk_a", "small", 9, 2), ("chk_b", "kept", 9, 0)]
    assert tables.table_location(spark, "chk_b").startswith("file:" + str(tmp_path)) and built["chk_b"].count() == 9
    spark.range(3).createOrReplaceTempView("chk_raw")
    with pytest.raises(ValueError, match="even"):
        reg.refresh(strict=True)
    assert spark.table("chk_a").count() == 9 and not [t.name for t in spark.catalog.listTables() if t.name.startswith("chk_a__")]
    reg.refresh()
    assert spark.table("chk_b").count() == 2
    spark.range(0).createOrReplaceTempView("chk_raw")
    reg.refresh(strict=True)
    assert spark.table("chk_b").count() == 0 and {r["rows"] for r in reg.report().collect()} == {0}
