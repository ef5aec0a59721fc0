"""Renames, recodes and row filters. All of them are projections: no shuffle, pushed into the scan stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorepipe.functions.columns import present, quoted


def rename_map(df: DataFrame, mapping: dict[str, str], strict: bool = True) -> DataFrame:
    """Rename by map. A missing source is an error when strict, otherwise it is left out."""
    missing = [c for c in mapping if not present(df, c)]
    if missing and strict:
        raise KeyError(f"no such columns: {missing}")
    return df.withColumnsRenamed(mapping)


def recoded(column: Column, mapping: dict[object, list]) -> Column:
    """Codes listed for a new code become it; every other value, NULL included, stays."""
    if not mapping:
        return column
    chain = F
    for new, olds in mapping.items():
        chain = chain.when(column.isin(*olds), F.lit(new))
    return chain.otherwise(column)


def recode(df: DataFrame, col: str, mapping: dict[object, list]) -> DataFrame:
    return recode_many(df, [col], mapping)


def recode_many(df: DataFrame, cols: list[str], mapping: dict[object, list]) -> DataFrame:
    """The same recode over many columns in one projection."""
    return df.withColumns({c: recoded(quoted(c), mapping) for c in cols})


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def split_xy(df: DataFrame, label: str, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and target as two projections; the key travels with both so they can be joined again."""
    keep = [quoted(key)] if key else []
    target = {label.lower(), (key or "").lower()}
    x = df.select(*keep, *[quoted(c) for c in df.columns if c.lower() not in target])
    return x, df.select(*keep, quoted(label))


def feature_names(df: DataFrame, label: str, key: str | None = None) -> list[str]:
    skip = {label.lower(), (key or "").lower()}
    return [c for c in df.columns if c.lower() not in skip]


def where_equals(df: DataFrame, col: str, value: object) -> DataFrame:
    return df.filter(quoted(col) == F.lit(value))


def where_in(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.filter(quoted(col).isin(*values))


def null_flags(df: DataFrame, cols: list[str], suffix: str = "_is_null") -> DataFrame:
    """1 where the column is NULL, else 0."""
    return df.withColumns({c + suffix: quoted(c).isNull().cast("int") for c in cols})


def drop_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows with no NULL (and no NaN) in the named columns, or in any column."""
    return df.na.drop("any", subset=cols)


def as_category(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mark columns as categories: their text form, ready for level discovery."""
    return df.withColumns({c: quoted(c).cast("string") for c in cols})
