"""Named tables, CSV files and parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from scorepipe.session import shared_dir


def table_name(name: str, schema: str | None = None, catalog: str | None = None) -> str:
    """One resolver for all spellings: `table`, `schema.table`, `catalog.schema.table`.

    Missing leading parts are filled from the arguments; given parts always win.
    """
    parts = name.split(".")
    if len(parts) > 3 or not all(parts):
        raise ValueError(f"not a table name: {name!r}")
    if len(parts) == 1 and schema:
        parts = [schema, *parts]
    if len(parts) == 2 and catalog:
        parts = [catalog, *parts]
    return ".".join(parts)


def read_table(
    spark: SparkSession, name: str, schema: str | None = None, catalog: str | None = None
) -> DataFrame:
    return spark.read.table(table_name(name, schema, catalog))


def read_parquet(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def register_folder(spark: SparkSession, folder: str, tables: list[str], prefix: str = "") -> None:
    """Parquet files of a folder as temporary views, so that they can be read by name."""
    for t in tables:
        read_parquet(spark, folder, t).createOrReplaceTempView(prefix + t)


def query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over named tables, or over frames given as ``{name}`` placeholders."""
    return spark.sql(text, **frames)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which costs one more scan."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema).option("enforceSchema", False) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def write_table(
    df: DataFrame, name: str, overwrite_schema: bool = True, fmt: str = "parquet", comment: str | None = None,
    path: str | None = None, accept: Callable[[str], None] | None = None,
) -> str:
    """Replace a table by the frame; running it again gives the same table.

    A transactional format replaces the table in one commit. Parquet does not, and overwriting a
    parquet table that the frame itself reads would destroy its input. The frame is therefore
    written to a staging table first and takes the name only once it is complete. ``accept`` is called in
    between with the name of the staging table: when it raises, the new rows are dropped and the old table stays. ``path`` is a fresh folder for
    the files, instead of the warehouse.
    """
    spark = df.sparkSession
    if not overwrite_schema and spark.catalog.tableExists(name):
        old = spark.read.table(name).schema
        if [(f.name, f.dataType) for f in old] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"schema of {name} differs and overwrite_schema is off")
    if fmt != "parquet":
        writer = df.write.mode("overwrite").format(fmt)
        writer.option("overwriteSchema", str(overwrite_schema).lower()).saveAsTable(name)
        return name
    tag = uuid.uuid4().hex[:12]
    staging, backup = f"{name}__new_{tag}", f"{name}__old_{tag}"
    writer = df.write.mode("errorifexists").format(fmt)
    if comment:
        writer = writer.option("comment", comment)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(staging)
    if accept:
        try:
            accept(staging)
        except Exception:
            spark.sql(f"DROP TABLE {staging}")
            raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
    except Exception:
        if replaced:
            spark.sql(f"ALTER TABLE {backup} RENAME TO {name}")
        raise
    if replaced:
        spark.sql(f"DROP TABLE {backup}")
    return name


def table_location(spark: SparkSession, name: str) -> str | None:
    """Storage location from the catalog, None for a view."""
    row = (
        spark.sql(f"DESCRIBE EXTENDED {name}")
        .filter((F.col("col_name") == "Location") & (F.col("data_type") != ""))
        .select("data_type")
        .first()
    )
    return row[0] if row else None


def preview(df: DataFrame, n: int, order_by: str | Column | list) -> DataFrame:
    """First n rows by an explicit order: a bounded heap per task, then one merge."""
    keys = order_by if isinstance(order_by, list) else [order_by]
    return df.orderBy(*keys).limit(n)


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as a frame (position, column, type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, column STRING, type STRING")


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def materialise(df: DataFrame) -> DataFrame:
    """Keep a frame for repeated reading by iterative fits.

    Blocks spill to disk, and a lost executor costs only the recomputation of its blocks.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def settled(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: iterations neither repeat nor lose what is done."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def dealt(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows dealt by the hash of their values and sorted, so that a fit which samples within partitions sees
    the same partitions however the rows arrived. The number of partitions is the session's, whatever the size.
    """
    key = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in cols])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key)
