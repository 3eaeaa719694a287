"""Grouped statistics and the numbers behind charts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.gram import pairwise_correlations
from tabloom.operators.profile import col, most_frequent, stacked, value_table
from tabloom.operators.quantiles import columns_of, exact_quantiles

#: Most columns a contingency table has; past it each row holds its cells in a map.
MAX_PIVOT = 1000


def mean_by_category(df: DataFrame, numeric: str, category: str) -> DataFrame:
    """Mean of a number per category, highest first, rows without a category left out."""
    means = df.where(col(category).isNotNull()).groupBy(col(category)).agg(
        F.avg(col(numeric)).alias(f"mean_{numeric}")
    )
    return means.orderBy(F.col(f"mean_{numeric}").desc_nulls_last(), col(category))


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Non-empty cells of a contingency table, for any number of categories."""
    both = df.where(col(a).isNotNull() & col(b).isNotNull())
    return both.groupBy(col(a), col(b)).agg(F.count(F.lit(1)).alias("n"))


def crosstab_sparse(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row per value of `a` with `counts`, a map from the values of `b` it meets to their counts."""
    cells = F.map_from_entries(F.sort_array(F.collect_list(F.struct(col(b).cast("string").alias("k"), F.col("n").alias("v")))))
    return crosstab_long(df, a, b).groupBy(col(a)).agg(cells.alias("counts"))


def crosstab(df: DataFrame, a: str, b: str, values: list[str] | None = None) -> DataFrame:
    """Contingency table with one column per value of `b`, or the sparse form where they are too many for
    columns."""
    if values is None:
        found = df.select(col(b)).where(col(b).isNotNull()).distinct().limit(MAX_PIVOT + 1).collect()
        if len(found) > MAX_PIVOT:
            return crosstab_sparse(df, a, b)
        values = sorted(r[0] for r in found)
    both = df.where(col(a).isNotNull() & col(b).isNotNull())
    wide = both.groupBy(col(a)).agg(
        *[F.count_if(col(b) == F.lit(v)).alias(str(v)) for v in values]
    )
    return wide


def _top(counted: DataFrame, group: str, value: str, n: int) -> DataFrame:
    """The `n` most frequent values per group. The rank filter is applied before the shuffle too
    (window group limit), so a large group reaches its task as `n` rows per input partition."""
    w = Window.partitionBy(group).orderBy(F.col("n").desc(), col(value).asc())
    return counted.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= n)


def top_values(df: DataFrame, cols: list[str], n: int = 10) -> DataFrame:
    counted = value_table(df, cols).where(F.col("value").isNotNull())
    return _top(counted, "column_name", "value", n)


def top_per_group(df: DataFrame, group: str, value: str, n: int = 5) -> DataFrame:
    return _top(crosstab_long(df, group, value), group, value, n)


def mode_by_group(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """(group, column_name, mode): most frequent non-null value, smallest on a tie.

    Counts per value come first, so a dominant group is reduced before it is ranked.
    """
    long = df.select(col(group), *[col(c).cast("string").alias(c) for c in cols]).unpivot(
        [col(group)], [col(c) for c in cols], "column_name", "value"
    )
    counted = long.groupBy(col(group), "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(col(group), "column_name").agg(
        most_frequent(F.col("value"), F.col("n")).alias("mode")
    )


def mode_global(df: DataFrame, cols: list[str]) -> DataFrame:
    return value_table(df, cols).groupBy("column_name").agg(
        most_frequent(F.col("value"), F.col("n")).alias("mode")
    )


def quantile_table(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    values = exact_quantiles(df, columns_of(cols), probs)
    rows = [(c, float(p), v) for c in cols for p, v in zip(probs, values[c])]
    return df.sparkSession.createDataFrame(rows, "column_name string, q double, value double")


def mean_median(df: DataFrame, cols: list[str]) -> DataFrame:
    medians = exact_quantiles(df, columns_of(cols), [0.5])
    row = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)])
    return stacked(
        row,
        [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"),
                  F.lit(medians[c][0]).cast("double").alias("median"))
         for i, c in enumerate(cols)],
    )


def mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    row = df.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(col(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    )
    return stacked(
        row,
        [F.struct(F.lit(c).alias("column_name"), F.col(f"m{i}").alias("mean"),
                  F.col(f"s{i}").alias("std")) for i, c in enumerate(cols)],
    )


def _ranges(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(
        *[F.min(col(c)).cast("double").alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(col(c)).cast("double").alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols) if row[f"lo{i}"] is not None}


def bin_of(c: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin number from 0; the last bin is closed; one bin when all values are equal."""
    if high <= low:
        return F.when(c.isNotNull(), F.lit(0).cast("bigint"))
    width = (high - low) / bins
    at = F.floor((c - F.lit(low)) / F.lit(width))
    return F.when(at >= bins, F.lit(bins - 1).cast("bigint")).otherwise(at)


def histogram(df: DataFrame, cols: list[str], bins: int = 50) -> DataFrame:
    """Counts of equal bins from min to max for every column, empty bins included, with the base-10
    logarithm of the count and the column's mean and median."""
    spark = df.sparkSession
    span = _ranges(df, cols)
    centre = {r["column_name"]: r for r in mean_median(df, list(span)).collect()}
    pairs = [
        F.struct(F.lit(c).alias("column_name"), bin_of(col(c).cast("double"), lo, hi, bins).alias("bin"))
        for c, (lo, hi) in span.items()
    ]
    counted = df.select(F.inline(F.array(*pairs))).groupBy("column_name", "bin").agg(
        F.count(F.lit(1)).alias("n")
    )
    frame = spark.createDataFrame(
        [
            (c, b, lo + b * (hi - lo) / bins, lo + (b + 1) * (hi - lo) / bins,
             centre[c]["mean"], centre[c]["median"])
            for c, (lo, hi) in span.items() for b in range(bins)
        ],
        "column_name string, bin long, low double, high double, mean double, median double",
    )
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    return F.broadcast(frame).join(counted, ["column_name", "bin"], "left").select(
        "column_name", "bin", "low", "high", n.alias("n"),
        F.when(n > 0, F.log10(n)).alias("log_n"), "mean", "median",
    )


def box_stats(df: DataFrame, cols: list[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the furthest points within `whisker` IQR, and outliers beyond."""
    q = exact_quantiles(df, columns_of(cols), [0.25, 0.5, 0.75])
    aggs, structs = [], []
    for i, c in enumerate(cols):
        q1, q2, q3 = q[c]
        if q1 is None:
            inside = F.lit(False)
        else:
            reach = whisker * (q3 - q1)
            inside = (col(c) >= q1 - reach) & (col(c) <= q3 + reach)
        aggs += [
            F.min(F.when(inside, col(c))).cast("double").alias(f"lo{i}"),
            F.max(F.when(inside, col(c))).cast("double").alias(f"hi{i}"),
            F.count_if(~inside).alias(f"out{i}"),
        ]
        structs.append(F.struct(
            F.lit(c).alias("column_name"),
            *[F.lit(v).cast("double").alias(k) for k, v in zip(("q25", "q50", "q75"), q[c])],
            F.col(f"lo{i}").alias("whisker_low"), F.col(f"hi{i}").alias("whisker_high"),
            F.col(f"out{i}").alias("n_outliers"),
        ))
    return stacked(df.agg(*aggs), structs)


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either is constant there."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    # covar / (sd * sd) rather than corr(): the latter divides by zero on a constant column.
    return F.when(varies, F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature_a, feature_b, corr) for every unordered pair, all pairs in one scan of moment matrices."""
    r = pairwise_correlations(df, cols)
    at = {c: i for i, c in enumerate(cols)}
    rows = [(a, b, float(r[at[a], at[b]])) for a, b in combinations(cols, 2)]
    rows = [(a, b, None if v != v else v) for a, b, v in rows]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def correlation_matrix(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    """Upper triangle rounded to two digits; `marked` where the size reaches the threshold."""
    r = F.bround("corr", 2)
    return correlations(df, cols).select(
        "feature_a", "feature_b", r.alias("corr"), (F.abs(r) >= threshold).alias("marked")
    )


def pair_bins(df: DataFrame, cols: list[str], hue: str | None = None, bins: int = 10) -> DataFrame:
    """Two-dimensional bin counts of every column pair, per value of `hue` when one is given."""
    span = _ranges(df, cols)
    pairs = [
        F.struct(
            F.lit(a).alias("column_x"), F.lit(b).alias("column_y"),
            bin_of(col(a).cast("double"), *span[a], bins).alias("bin_x"),
            bin_of(col(b).cast("double"), *span[b], bins).alias("bin_y"),
        )
        for a, b in combinations(span, 2)
    ]
    keys = [col(hue)] if hue else []
    rows = df.select(*keys, F.inline(F.array(*pairs)))
    return (
        rows.where(F.col("bin_x").isNotNull() & F.col("bin_y").isNotNull())
        .groupBy(*keys, "column_x", "column_y", "bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def group_presence(df: DataFrame, group: str, values: list[str]) -> DataFrame:
    """Rows of each listed group, zero when it is absent."""
    row = df.agg(*[F.count_if(col(group) == F.lit(v)).alias(f"n{i}") for i, v in enumerate(values)])
    return stacked(
        row,
        [F.struct(F.lit(v).alias(group), F.col(f"n{i}").alias("n")) for i, v in enumerate(values)],
    )
