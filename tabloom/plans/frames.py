"""Frames that several queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.typos import typo_table
from tabloom.operators import cleaning, split
from tabloom.operators.categories import infer_from
from tabloom.plans.sqltext import DIGITS
from tabloom.sources.cars import KEY, cars
from tabloom.storage import materialize

# Brand names of the derived car table.
CAR_BRANDS = ["africa", "america", "asia", "europe", "middle east"]
RULES = cleaning.CleanRules(brands=typo_table(CAR_BRANDS))


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded for comparison across engines; sums depend on row order in the last digits."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and categories cleaned, brand not inferred yet; lazy, so each query scans what it needs."""
    return cleaning.clean_categories(cleaning.clean_numbers(cars(spark, sf), RULES), RULES)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return infer_from(mapped(spark, sf), KEY, "model", "brand")


def branded(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.drop_null_rows(cleaned(spark, sf), ["brand"])


def split_cars(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified_split(branded(spark, sf), KEY, "brand")


def staged_split(spark: SparkSession, sf: str) -> DataFrame:
    """`split_cars` for those who need every column: inferring the brand, counting and marking each read the
    rows, so they are written before and not derived three times."""
    rows = infer_from(materialize(mapped(spark, sf), "cars"), KEY, "model", "brand")
    return split.stratified_split(cleaning.drop_null_rows(rows, ["brand"]), KEY, "brand")


def train(spark: SparkSession, sf: str) -> DataFrame:
    return split_cars(spark, sf).where(F.col("split") == "train")
