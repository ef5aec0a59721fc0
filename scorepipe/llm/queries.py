"""The registered queries of this package and the SQL that must give the same rows, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.llm import archive, audit, collocations, common, decontaminate, licenses, outliers, pieces, polytope, quality, render, reshard, simhash, suffix
from scorepipe.sources.tables import read_parquet

QUERIES = {}
ORACLES = {}


def query(f, sql=None):
    QUERIES[f.__name__] = f
    if sql:
        ORACLES[f.__name__] = sql
    return f


def query_with(sql):
    return lambda f: query(f, sql)


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(common.documents(spark, sf_dir), read_parquet(spark, sf_dir, "labels"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(common.documents(spark, sf_dir))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(common.documents(spark, sf_dir))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(common.documents(spark, sf_dir), pieces.read_model())


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.page_texts(read_parquet(spark, sf_dir, "pages"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archived_pages(read_parquet(spark, sf_dir, "pages"))


@query
def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 32 shards by source, one of them with a third of the rows, to 40 of equal counts."""
    by_source = F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % 32
    return reshard.reshard(common.documents(spark, sf_dir), by_source)[0]


@query
def op6_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules(common.documents(spark, sf_dir))


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(common.documents(spark, sf_dir))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(common.documents(spark, sf_dir), read_parquet(spark, sf_dir, "benchmark"))


@query_with(audit.AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(common.documents(spark, sf_dir), read_parquet(spark, sf_dir, "labels"))


@query_with(collocations.COLLOCATIONS_SQL)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(common.documents(spark, sf_dir))


@query
def op11_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.search(read_parquet(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
