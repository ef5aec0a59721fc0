"""Small expression helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> Column:
    """Column by its literal name; names may contain dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero denominator, also under ANSI mode."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rounded(value: Column, digits: int) -> Column:
    """Rounded double without negative zero, so that two engines print the same value."""
    return F.round(value.cast("double"), digits) + F.lit(0.0).cast("double")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name.lower() not in skip
    ]


def present(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def long_form(df: DataFrame, cols: list[str], keep: list[str] = (), cast: str = "double") -> DataFrame:
    """Columns to rows: (keep..., column, value). No shuffle: one output row per cell."""
    ids = [quoted(c) for c in keep]
    wide = df.select(*ids, *[quoted(c).cast(cast).alias(c) for c in cols])
    return wide.unpivot(ids, [quoted(c) for c in cols], "column", "value")
