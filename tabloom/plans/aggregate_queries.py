"""Grouped statistics and chart data."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabloom.functions.text import normalize_text
from tabloom.operators import canonical as K
from tabloom.operators import distributions as D
from tabloom.plans import frames
from tabloom.plans.frames import rounded
from tabloom.plans.registry import query
from tabloom.plans.sqltext import mode_cte, r, sql
from tabloom.sources.cars import CATEGORICAL, KEY, METRIC, cars
from tabloom.sources.files import read_table

NUMERIC = [*METRIC, "price"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query("mean_by_category", sql(
    f"SELECT brand, {r('avg(price)', 'mean_price')} FROM clean WHERE brand IS NOT NULL GROUP BY brand", "clean"))
def mean_by_category(spark, sf):
    return rounded(D.mean_by_category(frames.cleaned(spark, sf), "price", "brand"))


_GEARS = ["Automatic", "Manual", "Semi-Auto", "Unknown"]


@query("crosstab", sql("SELECT brand, " + ", ".join(
    f"count(*) FILTER (WHERE transmission = '{g}') AS \"{g}\"" for g in _GEARS)
    + " FROM clean WHERE brand IS NOT NULL AND transmission IS NOT NULL GROUP BY brand", "clean"))
def crosstab(spark, sf):
    return D.crosstab(frames.cleaned(spark, sf), "brand", "transmission", _GEARS)


@query("crosstab_long", sql("""SELECT brand, model, count(*) AS n FROM clean
    WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model""", "clean"))
def crosstab_long(spark, sf):
    return D.crosstab_long(frames.cleaned(spark, sf), "brand", "model")


def _top_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, {c} AS value, n, place AS rank FROM (
      SELECT {c}, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS place
      FROM clean WHERE {c} IS NOT NULL GROUP BY {c}) WHERE place <= 10"""


@query("top_values", sql(_union([_top_sql(c) for c in CATEGORICAL]), "clean"))
def top_values(spark, sf):
    return D.top_values(frames.cleaned(spark, sf), CATEGORICAL)


@query("top_models_per_brand", sql("""SELECT brand, model, n, place AS rank FROM (
    SELECT brand, model, count(*) AS n,
           row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, model) AS place
    FROM clean WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model) WHERE place <= 5""", "clean"))
def top_models_per_brand(spark, sf):
    return D.top_per_group(frames.cleaned(spark, sf), "brand", "model")


@query("mode_by_group", sql(_union([
    f"SELECT brand, '{c}' AS column_name, mode FROM ({mode_cte('branded', 'brand', c)})"
    for c in CATEGORICAL[1:]]), "branded"))
def mode_by_group(spark, sf):
    return D.mode_by_group(frames.branded(spark, sf), "brand", CATEGORICAL[1:])


@query("mode_global", sql(_union([
    f"SELECT '{c}' AS column_name, mode FROM ({mode_cte('clean', None, c)})" for c in CATEGORICAL]), "clean"))
def mode_global(spark, sf):
    return D.mode_global(frames.cleaned(spark, sf), CATEGORICAL)


_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("quantiles", sql(_union([
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS q, {r(f'quantile_cont({c}, {p})', 'value')} FROM clean"
    for c in NUMERIC for p in _PROBS]), "clean"))
def quantiles(spark, sf):
    return rounded(D.quantile_table(frames.cleaned(spark, sf), NUMERIC, _PROBS))


@query("mean_median", sql(_union([
    f"SELECT '{c}' AS column_name, {r(f'avg({c})', 'mean')}, {r(f'quantile_cont({c}, 0.5)', 'median')} FROM clean"
    for c in NUMERIC]), "clean"))
def mean_median(spark, sf):
    return rounded(D.mean_median(frames.cleaned(spark, sf), NUMERIC))


@query("mean_std", sql(_union([
    f"SELECT '{c}' AS column_name, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')} FROM clean"
    for c in NUMERIC]), "clean"))
def mean_std(spark, sf):
    return rounded(D.mean_std(frames.cleaned(spark, sf), NUMERIC))


def _hist_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, b.bin, {r('lo + b.bin * w', 'low')},
        {r('lo + (b.bin + 1) * w', 'high')}, coalesce(n, 0) AS n,
        CASE WHEN n > 0 THEN {r('log10(n)')} END AS log_n, {r('mean', 'mean')}, {r('median', 'median')}
      FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, (CAST(max({c}) AS DOUBLE) - min({c})) / 50 AS w,
                   avg({c}) AS mean, quantile_cont({c}, 0.5) AS median FROM clean) s,
           (SELECT unnest(range(50)) AS bin) b
      LEFT JOIN (
        SELECT least(CAST(floor(({c} - lo) / w) AS BIGINT), 49) AS bin, count(*) AS n FROM clean,
          (SELECT CAST(min({c}) AS DOUBLE) AS lo, (CAST(max({c}) AS DOUBLE) - min({c})) / 50 AS w FROM clean)
        WHERE {c} IS NOT NULL GROUP BY 1) h ON h.bin = b.bin"""


@query("histogram_50", sql(_union([_hist_sql(c) for c in NUMERIC]), "clean"))
def histogram_50(spark, sf):
    return rounded(D.histogram(frames.cleaned(spark, sf), NUMERIC, 50))


def _box_sql(c: str) -> str:
    inside = f"{c} BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)"
    return f"""SELECT '{c}' AS column_name, {r('any_value(q25)', 'q25')}, {r('any_value(q50)', 'q50')},
        {r('any_value(q75)', 'q75')}, {r(f'CAST(min({c}) FILTER ({inside}) AS DOUBLE)', 'whisker_low')},
        {r(f'CAST(max({c}) FILTER ({inside}) AS DOUBLE)', 'whisker_high')},
        count(*) FILTER (NOT ({inside})) AS n_outliers
      FROM clean, (SELECT quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
                          quantile_cont({c}, 0.75) AS q75 FROM clean)"""


@query("boxplot_stats", sql(_union([_box_sql(c) for c in NUMERIC]), "clean"))
def boxplot_stats(spark, sf):
    return rounded(D.box_stats(frames.cleaned(spark, sf), NUMERIC))


def corr_sql(a: str, b: str, source: str) -> str:
    return f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round_even(corr({a}, {b}), 2) + 0.0 AS corr FROM {source}"


@query("correlation_matrix", sql("SELECT *, abs(corr) >= 0.4 AS marked FROM (" + _union([
    corr_sql(a, b, "clean") for a, b in combinations(NUMERIC, 2)]) + ")", "clean"))
def correlation_matrix(spark, sf):
    return rounded(D.correlation_matrix(frames.cleaned(spark, sf), NUMERIC, 0.4))


def _bins_sql(a: str, b: str) -> str:
    code = lambda c: f"least(CAST(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / 10)) AS BIGINT), 9)"
    return f"""SELECT brand, '{a}' AS column_x, '{b}' AS column_y, {code(a)} AS bin_x, {code(b)} AS bin_y,
      count(*) AS n FROM clean, span WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY ALL"""


_SPAN = "SELECT " + ", ".join(
    f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}" for c in NUMERIC) + " FROM clean"


@query("pair_bins", sql(_union([_bins_sql(a, b) for a, b in combinations(NUMERIC, 2)]), "clean", span=_SPAN))
def pair_bins(spark, sf):
    return D.pair_bins(frames.cleaned(spark, sf), NUMERIC, "brand")


@query("group_presence", sql(_union([
    f"SELECT '{b}' AS brand, count(*) FILTER (WHERE brand = '{b}') AS n FROM clean"
    for b in [*frames.CAR_BRANDS, "atlantis"]]), "clean"))
def group_presence(spark, sf):
    return D.group_presence(frames.cleaned(spark, sf), "brand", [*frames.CAR_BRANDS, "atlantis"])


# --- fuzzy names: part names with an end letter dropped on some keys ---


def part_names(spark, sf):
    part = read_table(spark, f"{sf}/part.parquet")
    k, name = F.col("p_partkey"), F.col("p_name")
    spelled = F.when(k % 10 == 0, F.substring(name, 2, 100)).when(
        k % 10 == 1, F.substring(name, F.lit(1), F.length(name) - 1)).otherwise(name)
    return part.select("p_partkey", F.col("p_brand").alias("brand"), normalize_text(spelled).alias("model"))


@query("fuzzy_pairs")
def fuzzy_pairs(spark, sf):
    return K.fuzzy_pairs(part_names(spark, sf), "p_partkey", "brand", "model")


@query("canonical_models")
def canonical_models(spark, sf):
    return K.canonical_models(part_names(spark, sf), "p_partkey", "brand", "model")


@query("apply_canonical")
def apply_canonical(spark, sf):
    names = part_names(spark, sf)
    mapping = K.canonical_models(names, "p_partkey", "brand", "model")
    return K.apply_canonical(names, mapping, "brand", "model")


@query("rename_report")
def rename_report(spark, sf):
    return K.rename_report(K.canonical_models(part_names(spark, sf), "p_partkey", "brand", "model"), "model")
