"""The three layers of the client table: raw, clean, features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorepipe.operators.clean import recode, recode_many, rename_map
from scorepipe.operators.encode import fit_levels, level_map, one_hot
from scorepipe.plans.datasets import Registry

# Renames and code groups of the client table.
RENAMES = {"default_next": "de_pay", "pay_0": "pay_1"}
RAW_RENAMES = {"default.payment.next.month": "de_pay", "PAY_0": "PAY_1"}
EDUCATION_CODES = {4: [0, 5, 6]}
MARRIAGE_CODES = {3: [0]}
DELAY_CODES = {0: [-2, -1, 0]}

KEY, LABEL = "id", "de_pay"
DELAYS = [f"pay_{m}" for m in range(1, 7)]
CATEGORIES = ["sex", "education", "marriage"]
LEVELS = {"sex": [1, 2], "education": [1, 2, 3, 4], "marriage": [1, 2, 3]}
"""Level table of cleaned clients, for a schema that is fixed before any data is read."""


def clean(raw: DataFrame, renames: dict[str, str] = RENAMES, strict: bool = True) -> DataFrame:
    """Raw to clean: names, rare categories, payment delays."""
    df = rename_map(raw, renames, strict)
    df = recode(df, "education", EDUCATION_CODES)
    df = recode(df, "marriage", MARRIAGE_CODES)
    return recode_many(df, DELAYS, DELAY_CODES)


def features(silver: DataFrame, levels: dict[str, list] | None = None) -> DataFrame:
    """Clean to features: one-hot categories. The key stays as a key; it is not a feature.

    Without levels they are discovered from the data, one small job.
    """
    levels = levels or level_map(fit_levels(silver, CATEGORIES), CATEGORIES)
    return one_hot(silver, levels)


def layer_registry(
    spark: SparkSession, raw_table: str, levels: dict[str, list] | None = None, prefix: str = "client", folder: str | None = None
) -> Registry:
    """Clean and feature layers over a raw table, as datasets with the checks that every row should meet."""
    reg = Registry(spark, folder)
    silver, gold = f"{prefix}_silver", f"{prefix}_gold"
    known = {f"{c} known": F.col(c).isin(v) for c, v in LEVELS.items()}
    paid = reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in DELAYS])
    reg.dataset(silver, "names and codes cleaned", [raw_table], {**known, "key present": F.col(KEY).isNotNull(), "delays from zero up": paid})(clean)
    label = {"label 0 or 1": F.col(LABEL).isin(0, 1), "older than 25": F.col("age") > 25}
    reg.dataset(gold, "one-hot features, ready for modelling", [silver], label)(lambda s: features(s, levels))
    return reg
