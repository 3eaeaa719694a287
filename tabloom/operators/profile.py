"""Profiling: shapes, null counts, summaries, frequency tables. Each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.quantiles import columns_of, exact_quantiles


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def any_null(cols: list[str]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | col(c).isNull()
    return out


def columns_by_type(df: DataFrame, numeric: bool) -> list[str]:
    """Names of numeric columns, or of all others, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) == numeric]


def subset_by_type(df: DataFrame, numeric: bool) -> DataFrame:
    return df.select(*[col(c) for c in columns_by_type(df, numeric)])


def stacked(row: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn a one-row frame into one row per struct."""
    return row.select(F.inline(F.array(*structs)))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def last_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(key).desc()).limit(n)


def sort_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def column_info(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column."""
    row = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return stacked(
        row,
        [
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, f in enumerate(df.schema.fields)
        ],
    )


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    row = df.agg(*[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    return stacked(
        row,
        [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_null"))
         for i, c in enumerate(cols)],
    )


def null_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count_if(col(name).isNull()).alias("n_null"))


def _summary_aggs(name: str, c: Column) -> list[Column]:
    return [
        F.count(c).alias(f"{name}_count"),
        F.avg(c).alias(f"{name}_mean"),
        F.stddev_samp(c).alias(f"{name}_std"),
        F.min(c).cast("double").alias(f"{name}_min"),
        F.max(c).cast("double").alias(f"{name}_max"),
    ]


def summary_of(df: DataFrame, exprs: dict[str, Column], label: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each expression."""
    quartiles = exact_quantiles(df, exprs, [0.25, 0.5, 0.75])
    names = list(exprs)
    row = df.agg(*[a for i, n in enumerate(names) for a in _summary_aggs(f"s{i}", exprs[n])])
    return stacked(
        row,
        [
            F.struct(
                F.lit(n).alias(label),
                F.col(f"s{i}_count").alias("count"),
                F.col(f"s{i}_mean").alias("mean"),
                F.col(f"s{i}_std").alias("std"),
                F.col(f"s{i}_min").alias("min"),
                *[F.lit(q).cast("double").alias(k)
                  for k, q in zip(("q25", "q50", "q75"), quartiles[n])],
                F.col(f"s{i}_max").alias("max"),
            )
            for i, n in enumerate(names)
        ],
    )


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or columns_by_type(df, numeric=True)
    return summary_of(df, columns_of(cols), "column_name")


def conditional_profile(df: DataFrame, a: str, b: str) -> DataFrame:
    """Summary of `a` over all rows beside the one over rows where `b` is null."""
    exprs = {"all": col(a), f"{b} is null": F.when(col(b).isNull(), col(a))}
    return summary_of(df, exprs, "scope")


def value_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, n) over several text columns, nulls included, in one shuffle."""
    long = df.select(*[col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "column_name", "value"
    )
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(value: Column, n: Column) -> Column:
    """Aggregate: the non-null value with the highest `n`, the smallest one on a tie."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-n, value)))


def describe_categorical(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Non-null count, distinct values, most frequent value and its frequency."""
    cols = cols or columns_by_type(df, numeric=False)
    v, n = F.col("value"), F.col("n")
    held = F.when(v.isNotNull(), n)
    return value_table(df, cols).groupBy("column_name").agg(
        F.coalesce(F.sum(held), F.lit(0)).cast("bigint").alias("count"),
        F.count(v).alias("unique"),
        most_frequent(v, n).alias("top"),
        F.max(held).alias("freq"),
    )


def before_after_categories(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """Categorical summaries of two states of a table side by side."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        d = describe_categorical(df, cols)
        return d.select("column_name", *[F.col(c).alias(f"{c}_{tag}") for c in d.columns[1:]])

    return side(before, "before").join(side(after, "after"), "column_name", "full")


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct()


def value_counts(df: DataFrame, name: str, dropna: bool = True) -> DataFrame:
    kept = df.where(col(name).isNotNull()) if dropna else df
    counted = kept.groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), col(name).asc_nulls_last())


def count_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.agg(F.count_if(predicate).alias("n"))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


def fill_report(df: DataFrame, before: str, after: str) -> DataFrame:
    """Nulls before and after a fill, both held as columns of one frame."""
    b, a = F.count_if(col(before).isNull()), F.count_if(col(after).isNull())
    return df.agg(b.alias("nulls_before"), a.alias("nulls_after"), (b - a).alias("filled"))


def non_integer_rows(df: DataFrame, name: str) -> DataFrame:
    from tabloom.functions.numeric import is_not_whole

    return df.where(is_not_whole(col(name)))
