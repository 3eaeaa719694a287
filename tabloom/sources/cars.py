"""The car table derived from the star schema, as one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.sources.files import read_table, spread

KEY = "car_id"
LABEL = "price"
CATEGORICAL = ["brand", "model", "transmission", "fuel_type"]
RAW_NUMERIC = [
    "year", "mileage", "tax", "mpg", "engine_size", "paint_quality", "previous_owners",
    "has_damage", "price",
]
#: Numeric features after cleaning.
METRIC = [
    "car_age", "mileage", "engine_size", "paint_quality", "previous_owners", "tax", "mpg",
]

CARS_SQL = """
WITH base AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus, o.o_orderpriority, o.o_orderdate, o.o_totalprice,
         c.c_acctbal, n.n_nationkey, r.r_name
  FROM {orders} o
  JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey),
named AS (
  SELECT *, lower(r_name) AS b,
         CASE o_orderstatus WHEN 'F' THEN 'manual' WHEN 'O' THEN 'automatic' ELSE 'semi-auto' END AS t,
         CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'petrol' WHEN '2' THEN 'diesel'
              WHEN '3' THEN 'hybrid' WHEN '4' THEN 'other' ELSE 'electric' END AS f,
         CAST(extract(year FROM o_orderdate) AS DOUBLE) AS y
  FROM base)
SELECT k AS car_id,
  CASE WHEN k % 29 = 0 THEN NULL
       WHEN k % 10 = 0 THEN substring(b, 2, length(b) - 1)
       WHEN k % 10 = 1 THEN substring(b, 1, length(b) - 1)
       WHEN k % 10 = 2 THEN substring(b, 2, length(b) - 2)
       WHEN k % 10 = 3 THEN upper(b)
       WHEN k % 10 = 4 THEN concat('  ', b, '! ')
       ELSE b END AS brand,
  CASE WHEN k % 47 = 0 THEN NULL
       WHEN k % 13 = 0 THEN concat('Clas  ', CAST(n_nationkey AS VARCHAR(9)))
       ELSE concat('class ', CAST(n_nationkey AS VARCHAR(9))) END AS model,
  CASE WHEN k % 43 = 0 THEN NULL WHEN k % 11 = 0 THEN y + CAST(0.5 AS DOUBLE) ELSE y END AS year,
  CASE WHEN k % 37 = 0 THEN NULL WHEN k % 31 = 0 THEN 'unknown'
       WHEN k % 5 = 0 THEN substring(t, 2, length(t) - 1) ELSE t END AS transmission,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 7 = 0 THEN substring(f, 1, length(f) - 1) ELSE f END AS fuel_type,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 53 = 0 THEN -o_totalprice ELSE o_totalprice END AS mileage,
  CASE WHEN k % 23 = 0 THEN NULL ELSE c_acctbal END AS tax,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 61 = 0 THEN CAST(-5 AS DOUBLE)
       WHEN k % 97 = 0 THEN CAST(400 AS DOUBLE) ELSE CAST(20 + (k * 7) % 60 AS DOUBLE) END AS mpg,
  CAST(k % 50 AS DOUBLE) / CAST(10 AS DOUBLE) - CASE WHEN k % 101 = 0 THEN CAST(9 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS engine_size,
  CAST((k * 7) % 110 AS DOUBLE) AS paint_quality,
  CAST((k * 3) % 10 AS DOUBLE) - CAST(1 AS DOUBLE) + CASE WHEN k % 71 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS previous_owners,
  CASE WHEN k % 2 = 0 THEN NULL ELSE CAST(0 AS DOUBLE) END AS has_damage,
  CAST(40000 + (k % 50) * 400 + (k * 7919) % 1000 AS DOUBLE) - CAST(1500 AS DOUBLE) * (CAST(2002 AS DOUBLE) - y) AS price
FROM named
"""


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw, dirty car table over all orders."""
    names = ("orders", "customer", "nation", "region")
    frames = {n: read_table(spark, f"{sf_dir}/{n}.parquet") for n in names}
    frames["orders"] = spread(frames["orders"], "o_orderkey")
    return spark.sql(CARS_SQL, **frames)
