"""Profiling queries over the raw car table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import profile as P
from tabloom.plans import frames
from tabloom.plans.frames import rounded
from tabloom.plans.registry import query
from tabloom.plans.sqltext import norm, r, sql
from tabloom.sources.cars import CATEGORICAL, KEY, RAW_NUMERIC, cars

ALL = ["car_id", "brand", "model", "year", "transmission", "fuel_type", "mileage", "tax", "mpg",
       "engine_size", "paint_quality", "previous_owners", "has_damage", "price"]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def describe_sql(c: str, source: str, label: str, name: str, where: str = "") -> str:
    q = lambda p: r(f"quantile_cont({c}, {p})")
    return f"""SELECT '{name}' AS {label}, count({c}) AS count, {r(f'avg({c})', 'mean')},
      {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, {q(0.25)} AS q25, {q(0.5)} AS q50,
      {q(0.75)} AS q75, {r(f'max({c})', 'max')} FROM {source} {where}"""


def categorical_sql(c: str, source: str, expr: str | None = None, tag: str = "") -> str:
    e = expr or c
    return f"""SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count{tag}, count(*) AS unique{tag},
      arg_min(v, place) AS top{tag}, max(n) AS freq{tag} FROM (
      SELECT v, n, row_number() OVER (ORDER BY n DESC, v) AS place FROM (
      SELECT {e} AS v, count(*) AS n FROM {source} WHERE {e} IS NOT NULL GROUP BY 1))"""


@query("shape", sql("SELECT count(*) AS n_rows, CAST(14 AS BIGINT) AS n_columns FROM cars", "cars"))
def shape(spark, sf):
    return P.shape(cars(spark, sf))


@query("head", sql("SELECT * FROM cars ORDER BY car_id LIMIT 5", "cars"))
def head(spark, sf):
    return P.first_rows(cars(spark, sf), KEY)


@query("tail", sql("SELECT * FROM cars ORDER BY car_id DESC LIMIT 5", "cars"))
def tail(spark, sf):
    return P.last_rows(cars(spark, sf), KEY)


@query("sort_by_key", sql("SELECT * FROM cars ORDER BY car_id", "cars"))
def sort_by_key(spark, sf):
    return P.sort_by_key(cars(spark, sf), KEY)


_TYPES = {"car_id": "bigint", **{c: "string" for c in CATEGORICAL}}


@query("column_info", sql(_union([
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{_TYPES.get(c, 'double')}' AS data_type, "
    f"count({c}) AS non_null FROM cars" for i, c in enumerate(ALL)]), "cars"))
def column_info(spark, sf):
    return P.column_info(cars(spark, sf))


@query("null_counts", sql(_union([
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM cars" for c in ALL]), "cars"))
def null_counts(spark, sf):
    return P.null_counts(cars(spark, sf))


@query("null_count_column", sql("SELECT count(*) FILTER (WHERE brand IS NULL) AS n_null FROM cars", "cars"))
def null_count_column(spark, sf):
    return P.null_count(cars(spark, sf), "brand")


@query("describe_numeric", sql(_union([describe_sql(c, "cars", "column_name", c) for c in RAW_NUMERIC]), "cars"))
def describe_numeric(spark, sf):
    return rounded(P.describe_numeric(cars(spark, sf), RAW_NUMERIC))


@query("describe_column", sql(describe_sql("year", "cars", "column_name", "year"), "cars"))
def describe_column(spark, sf):
    return rounded(P.describe_numeric(cars(spark, sf), ["year"]))


@query("describe_categorical", sql(_union([categorical_sql(c, "cars") for c in CATEGORICAL]), "cars"))
def describe_categorical(spark, sf):
    return P.describe_categorical(cars(spark, sf), CATEGORICAL)


@query("distinct_values", sql("SELECT DISTINCT transmission FROM cars", "cars"))
def distinct_values(spark, sf):
    return P.distinct_values(cars(spark, sf), "transmission")


@query("value_counts", sql("SELECT brand, count(*) AS n FROM cars WHERE brand IS NOT NULL GROUP BY brand", "cars"))
def value_counts(spark, sf):
    return P.value_counts(cars(spark, sf), "brand")


@query("value_counts_with_null", sql("SELECT transmission, count(*) AS n FROM cars GROUP BY transmission", "cars"))
def value_counts_with_null(spark, sf):
    return P.value_counts(cars(spark, sf), "transmission", dropna=False)


@query("count_where", sql("SELECT count(*) AS n FROM cars WHERE mpg < 0", "cars"))
def count_where(spark, sf):
    return P.count_where(cars(spark, sf), F.col("mpg") < 0)


@query("conditional_profile", sql(_union([
    describe_sql("previous_owners", "cars", "scope", "all"),
    describe_sql("previous_owners", "cars", "scope", "has_damage is null", "WHERE has_damage IS NULL")]), "cars"))
def conditional_profile(spark, sf):
    return rounded(P.conditional_profile(cars(spark, sf), "previous_owners", "has_damage"))


def _compared(c: str) -> str:
    before = categorical_sql(c, "cars", tag="_before")
    after = categorical_sql(c, "cars", norm(c), tag="_after")
    return f"SELECT b.*, a.* EXCLUDE (column_name) FROM ({before}) b JOIN ({after}) a USING (column_name)"


@query("before_after_categories", sql(_union([_compared(c) for c in CATEGORICAL]), "cars"))
def before_after_categories(spark, sf):
    from tabloom.functions.text import normalize_text

    before = cars(spark, sf)
    after = before.withColumns({c: normalize_text(F.col(c)) for c in CATEGORICAL})
    return P.before_after_categories(before, after, CATEGORICAL)


@query("fill_report", sql("""
    SELECT count(*) FILTER (WHERE m.brand IS NULL) AS nulls_before,
           count(*) FILTER (WHERE c.brand IS NULL) AS nulls_after,
           count(*) FILTER (WHERE m.brand IS NULL AND c.brand IS NOT NULL) AS filled
    FROM mapped m JOIN clean c USING (car_id)""", "clean"))
def fill_report(spark, sf):
    from tabloom.operators.categories import infer_from

    before = frames.mapped(spark, sf).withColumn("brand_before", F.col("brand"))
    return P.fill_report(infer_from(before, KEY, "model", "brand"), "brand_before", "brand")


@query("non_integer_rows", sql("""
    SELECT car_id, previous_owners FROM cars
    WHERE previous_owners IS NULL OR previous_owners % 1 <> 0""", "cars"))
def non_integer_rows(spark, sf):
    return P.non_integer_rows(cars(spark, sf), "previous_owners").select("car_id", "previous_owners")


@query("split_sizes", sql("SELECT split, count(*) AS n FROM split_cars GROUP BY split", "split_cars"))
def split_sizes(spark, sf):
    return P.split_sizes(frames.split_cars(spark, sf))
