"""Cleaning, text and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import numeric as N
from tabloom.functions import text, typos
from tabloom.operators import categories as C
from tabloom.operators import cleaning, split
from tabloom.operators.profile import subset_by_type
from tabloom.plans import frames
from tabloom.plans.frames import RULES
from tabloom.plans.registry import query
from tabloom.plans.sqltext import capitalized, norm, sql, word_fixed
from tabloom.sources.cars import KEY, cars
from tabloom.sources.files import check_key, read_table


def _column(name: str, column: str, fn, expr: str) -> None:
    """Query that changes one column of the car table and returns it with the key."""
    text_sql = sql(f"SELECT car_id, {expr} AS {column} FROM cars", "cars")
    query(name, text_sql)(lambda spark, sf: cars(spark, sf).select(KEY, fn(F.col(column)).alias(column)))


_column("floor_whole", "year", N.floor_whole, "CAST(floor(year) AS BIGINT)")
_column("negative_to_null", "mileage", N.negative_to_null, "CASE WHEN mileage >= 0 THEN mileage END")
_column("over_limit_to_null", "paint_quality", N.over_limit_to_null, "CASE WHEN paint_quality <= 100 THEN paint_quality END")
_column("zero_to_null", "engine_size", N.zero_to_null, "nullif(engine_size, 0)")
_column("round_half_even", "previous_owners", lambda c: N.round_half_even(c) + F.lit(0.0), "round_even(previous_owners, 0) + 0.0")
_column("sentinel_to_null", "transmission", lambda c: N.sentinel_to_null(c, "unknown"), "nullif(transmission, 'unknown')")


@query("read_keyed_table", "SELECT * FROM customer")
def read_keyed_table(spark, sf):
    return check_key(read_table(spark, f"{sf}/customer.parquet"), "c_custkey")


@query("derive_age", sql("SELECT car_id, CAST(2024 - floor(year) AS BIGINT) AS car_age FROM cars", "cars"))
def derive_age(spark, sf):
    aged = cars(spark, sf).withColumn("year", N.age_from_year(F.col("year"), 2024))
    return cleaning.rename(aged, {"year": "car_age"}).select(KEY, "car_age")


@query("drop_columns", sql("SELECT * EXCLUDE (has_damage, year) FROM cars", "cars"))
def drop_columns(spark, sf):
    return cleaning.drop_columns(cars(spark, sf), ["has_damage", "year"])


@query("subset_by_type", sql("""SELECT car_id, year, mileage, tax, mpg, engine_size, paint_quality,
    previous_owners, has_damage, price FROM cars""", "cars"))
def numeric_columns(spark, sf):
    return subset_by_type(cars(spark, sf), numeric=True)


@query("filter_compare", sql("SELECT * FROM cars WHERE tax < 0", "cars"))
def filter_compare(spark, sf):
    return cars(spark, sf).where(F.col("tax") < 0)


@query("filter_compound_null_safe", sql(
    "SELECT * FROM cars WHERE engine_size < 0 AND brand IS DISTINCT FROM 'europe'", "cars"))
def filter_compound(spark, sf):
    return cars(spark, sf).where((F.col("engine_size") < 0) & cleaning.differs(F.col("brand"), "europe"))


@query("drop_null_rows", sql("SELECT * FROM cars WHERE brand IS NOT NULL", "cars"))
def drop_null_rows(spark, sf):
    return cleaning.drop_null_rows(cars(spark, sf), ["brand"])


_LAYOUT = T.StructType([
    T.StructField("mpg", T.DoubleType()), T.StructField("tax", T.DoubleType()),
    T.StructField("doors", T.LongType()), T.StructField("car_id", T.LongType())])


@query("align_columns", sql("SELECT mpg, tax, CAST(NULL AS BIGINT) AS doors, car_id FROM cars", "cars"))
def align_columns(spark, sf):
    return cleaning.align_columns(cars(spark, sf), _LAYOUT)


@query("clean_recipe", sql("SELECT * FROM clean", "clean"))
def clean_recipe(spark, sf):
    return cleaning.clean(cars(spark, sf), RULES)


# --- text ---

_TEXT = ["brand", "model", "transmission", "fuel_type"]


@query("normalize_text", sql(f"SELECT car_id, {', '.join(f'{norm(c)} AS {c}' for c in _TEXT)} FROM cars", "cars"))
def normalize_text(spark, sf):
    return cars(spark, sf).select(KEY, *[text.normalize_text(F.col(c)).alias(c) for c in _TEXT])


def _mapped(name: str, column: str, table: dict, cte: str) -> None:
    body = f"SELECT car_id, m.canonical AS {column} FROM cars c LEFT JOIN {cte} m ON {norm(f'c.{column}')} = m.spelling"
    query(name, sql(body, "cars", cte))(lambda spark, sf: cars(spark, sf).select(
        KEY, typos.map_values(text.normalize_text(F.col(column)), table).alias(column)))


_mapped("map_brand", "brand", RULES.brands, "brand_map")
_mapped("map_fuel", "fuel_type", RULES.fuels, "fuel_map")
_mapped("map_transmission", "transmission", RULES.transmissions, "gear_map")


@query("typo_table", sql("SELECT spelling, canonical FROM brand_map", "brand_map"))
def typo_table(spark, sf):
    names = read_table(spark, f"{sf}/region.parquet").select(F.lower("r_name").alias("name"))
    return typos.typo_frame(spark, names, "name")


@query("regex_word_fix", sql(f"SELECT car_id, {word_fixed(norm('model'))} AS model FROM cars", "cars"))
def regex_word_fix(spark, sf):
    return cars(spark, sf).select(KEY, text.replace_word(text.normalize_text(F.col("model"))).alias("model"))


@query("capitalize_first", sql(f"SELECT car_id, {capitalized('model')} AS model FROM cars", "cars"))
def capitalize_first(spark, sf):
    return cars(spark, sf).select(KEY, text.capitalize_first(F.col("model")).alias("model"))


@query("models_per_brand", sql("""SELECT brand, model, min(car_id) AS first_seen FROM mapped
    WHERE brand IS NOT NULL AND model IS NOT NULL GROUP BY brand, model""", "mapped"))
def models_per_brand(spark, sf):
    return C.values_per_group(frames.mapped(spark, sf), KEY, "brand", "model")


@query("infer_brand", sql("SELECT car_id, brand FROM clean", "clean"))
def infer_brand(spark, sf):
    return C.infer_from(frames.mapped(spark, sf), KEY, "model", "brand").select(KEY, "brand")


# --- joins ---

@query("join_inner_key", """SELECT l_orderkey, l_partkey, l_quantity, o_totalprice, o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner_key(spark, sf):
    items = read_table(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_totalprice", "o_orderpriority")
    return C.join_on_key(items, orders, "l_orderkey")


_SEGMENTS = {"BUILDING": "b", "MACHINERY": "m", "HOUSEHOLD": "h"}
_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SEGMENTS.items())


@query("lookup_left", f"SELECT c_custkey, CASE c_mktsegment {_CASES} END AS code FROM customer")
def lookup_left(spark, sf):
    customer = read_table(spark, f"{sf}/customer.parquet")
    return customer.select("c_custkey", typos.map_values(F.col("c_mktsegment"), _SEGMENTS).alias("code"))


@query("lookup_table", "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def lookup_table(spark, sf):
    nation = read_table(spark, f"{sf}/nation.parquet").withColumnRenamed("n_nationkey", "s_nationkey")
    supplier = read_table(spark, f"{sf}/supplier.parquet")
    return C.lookup(supplier, nation, "s_nationkey", "n_name", "n_name").select("s_suppkey", "s_name", "n_name")


@query("lookup_default", f"SELECT c_custkey, coalesce(CASE c_mktsegment {_CASES} END, '?') AS code FROM customer")
def lookup_default(spark, sf):
    customer = read_table(spark, f"{sf}/customer.parquet")
    code = typos.map_values(F.col("c_mktsegment"), _SEGMENTS, F.lit("?"))
    return customer.select("c_custkey", code.alias("code"))


@query("semi_join_keys", sql("""SELECT * FROM cars WHERE car_id IN
    (SELECT car_id FROM split_cars WHERE split = 'train')""", "cars", "split_cars"))
def semi_join_keys(spark, sf):
    return C.keep_keys(cars(spark, sf), frames.train(spark, sf), KEY)


@query("concat_columns", sql("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders"))
def concat_columns(spark, sf):
    orders = read_table(spark, f"{sf}/orders.parquet")
    numbers, words = orders.select("o_orderkey", "o_totalprice"), orders.select("o_orderkey", "o_orderpriority")
    return C.join_on_key(numbers, words, "o_orderkey")


@query("union_groups", """SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def union_groups(spark, sf):
    a = read_table(spark, f"{sf}/customer.parquet").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    b = read_table(spark, f"{sf}/supplier.parquet").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return C.stack_rows([a, b])


@query("stratified_split", sql("SELECT car_id, brand, split FROM split_cars", "split_cars"))
def stratified_split(spark, sf):
    return split.stratified_split(frames.branded(spark, sf), KEY, "brand").select(KEY, "brand", "split")
