"""Models per brand, brand from model, and dictionary lookups held in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import col
from tabloom.storage import settle


def values_per_group(df: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """Distinct non-null values per group with the lowest key that shows them: (group, value,
    first_seen). One row per distinct pair, so a dominant group stays spread over tasks."""
    both = df.where(col(group).isNotNull() & col(value).isNotNull())
    return both.groupBy(col(group), col(value)).agg(F.min(col(key)).alias("first_seen"))


def first_group_of(df: DataFrame, key: str, value: str, group: str) -> DataFrame:
    """(value, inferred): the group seen with each value at the lowest key."""
    both = df.where(col(group).isNotNull() & col(value).isNotNull())
    return both.groupBy(col(value)).agg(F.min_by(col(group), col(key)).alias("inferred"))


def infer_from(df: DataFrame, key: str, value: str, group: str) -> DataFrame:
    """Fill a missing group from the value; rows that have one keep it."""
    known = settle(first_group_of(df, key, value, group), "inferred")
    filled = F.coalesce(col(group), F.col("inferred"))
    return df.join(known, value, "left").select(
        *[filled.alias(c) if c == group else col(c) for c in df.columns]
    )


def lookup(
    df: DataFrame, table: DataFrame, on: str, found: str, out: str, default: Column | None = None
) -> DataFrame:
    """Left-join a (on, found) table; a miss is NULL or `default`. The table must hold each key
    once. Spark broadcasts it when its size is under the session's threshold."""
    named = table.select(col(on), col(found).alias("__found"))
    value = F.col("__found") if default is None else F.coalesce(F.col("__found"), default)
    return df.join(named, on, "left").select(*[col(c) for c in df.columns if c != out], value.alias(out))


def keep_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def join_on_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b, key, "inner")


def stack_rows(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
