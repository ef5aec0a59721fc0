import pytest
from conftest import rows
from pyspark.sql import functions as F

from scorepipe.operators import clean, encode
from scorepipe.plans import layers


def test_rename_dotted_and_missing(spark):
    df = spark.createDataFrame([(1, 2)], "`default.payment.next.month` INT, PAY_0 INT")
    assert clean.rename_map(df, layers.RAW_RENAMES).columns == ["de_pay", "PAY_1"]
    done = spark.createDataFrame([(1, 2)], "de_pay INT, PAY_1 INT")
    assert clean.rename_map(done, layers.RAW_RENAMES, strict=False).columns == ["de_pay", "PAY_1"]
    with pytest.raises(KeyError):
        clean.rename_map(done, layers.RAW_RENAMES)


def test_recode_keeps_null_and_type(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 2, 3, 4, 5, 6, None]], "education INT")
    out = clean.recode(df, "education", layers.EDUCATION_CODES)
    assert [r[0] for r in out.collect()] == [4, 1, 2, 3, 4, 4, 4, None]
    assert out.dtypes == [("education", "int")]
    assert clean.recode(df, "education", {}).collect() == df.collect()


def test_recode_many_is_one_projection(spark):
    df = spark.createDataFrame([(-2, 3), (-1, 0), (None, 8)], "pay_1 INT, pay_2 INT")
    out = clean.recode_many(df, ["pay_1", "pay_2"], layers.DELAY_CODES)
    assert [tuple(r) for r in out.collect()] == [(0, 3), (0, 0), (None, 8)]


def test_split_xy_and_drop(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "id INT, a DOUBLE, y INT")
    x, y = clean.split_xy(df, "y", "id")
    assert x.columns == ["id", "a"] and y.columns == ["id", "y"]
    assert clean.feature_names(df, "y", "id") == ["a"]
    assert clean.drop_columns(df, "id").columns == ["a", "y"]


def test_null_flags_and_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a INT, b INT")
    assert rows(clean.null_flags(df, ["a"]), "a_is_null") == [(0,), (0,), (1,)]
    assert clean.drop_nulls(df).count() == 1
    assert clean.drop_nulls(df, ["a"]).count() == 2
    assert clean.as_category(df, ["a"]).dtypes[0] == ("a", "string")


def test_one_hot_null_unseen_and_order(spark):
    train = spark.createDataFrame([(1, 2, 9), (1, 1, 9), (2, None, 9)], "sex INT, education INT, age INT")
    levels = encode.level_map(encode.fit_levels(train, ["sex", "education"]), ["sex", "education"])
    assert levels == {"sex": [1, 2], "education": [1, 2]}
    new = spark.createDataFrame([(1, None, 5), (3, 2, 6)], "sex INT, education INT, age INT")
    out = encode.one_hot(new, levels)
    assert out.columns == ["age", "sex_1", "sex_2", "education_1", "education_2"]
    assert [tuple(r) for r in out.collect()] == [(5, 1, 0, 0, 0), (6, 0, 0, 0, 1)]
    assert dict(out.dtypes)["sex_1"] == "int"


def test_one_hot_rows_sum_to_one(gold):
    for c, levels in layers.LEVELS.items():
        total = sum(F.col(f"{c}_{v}") for v in levels)
        assert gold.filter(total != 1).count() == 0


def test_level_guard(spark):
    df = spark.range(50).select(F.col("id").alias("x"))
    with pytest.raises(ValueError):
        encode.level_map(encode.fit_levels(df, ["x"]), ["x"], max_levels=10)


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE")
    stats = encode.fit_scaler(df, ["a", "b"])
    assert rows(stats) == [("a", 2.0, 1.0), ("b", 5.0, 0.0)]
    assert rows(encode.scale(df, stats)) == [(-1.0, 0.0), (1.0, 0.0)]


def test_clean_domains(spark, gold):
    from scorepipe.queries.base import silver
    from conftest import MEDIUM

    s = silver(spark, MEDIUM)
    assert s.filter(~F.col("education").isin(1, 2, 3, 4) | ~F.col("marriage").isin(1, 2, 3)).count() == 0
    assert s.filter(" OR ".join(f"{c} < 0" for c in layers.DELAYS)).count() == 0
    assert s.count() == gold.count() == 1500
    assert len(s.columns) == 25 and len(gold.columns) == 31
