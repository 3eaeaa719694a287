"""Sinks, each written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators.categories import lookup
from tabloom.plans import frames
from tabloom.plans.frames import rounded
from tabloom.plans.registry import query
from tabloom.plans.selection_queries import train_of
from tabloom.plans.sqltext import r, sql
from tabloom.sources import files
from tabloom.sources.cars import KEY
from tabloom.storage import new_path

_STAGE = [KEY, "brand", "model", "mileage", "price"]


@query("sink_stage", sql(f"SELECT {', '.join(_STAGE)} FROM mapped", "mapped"))
def sink_stage(spark, sf):
    """The cleaned table as CSV with a header."""
    rows = frames.mapped(spark, sf).select(*_STAGE)
    path = new_path(spark, "stage-csv")
    files.write_stage(rows, path, "csv")
    return files.read_csv(spark, path, rows.schema)


@query("sink_split", sql("SELECT car_id, price, split FROM split_cars", "split_cars"))
def sink_split(spark, sf):
    """Train and validation rows in one folder each."""
    path = new_path(spark, "split")
    files.write_split(frames.split_cars(spark, sf).select(KEY, "price", "split"), path)
    return spark.read.parquet(path).select(KEY, "price", F.col("split").cast("string").alias("split"))


@query("sink_predictions", sql(
    f"""SELECT s.car_id, {r('m.p', 'price')} FROM split_cars s JOIN (SELECT brand, avg(price) AS p FROM train GROUP BY brand) m
    USING (brand) WHERE s.split <> 'train'""", "split_cars", "train"))
def sink_predictions(spark, sf):
    """Key and predicted price alone; the prediction is the train mean of the brand."""
    rows = frames.split_cars(spark, sf)
    means = train_of(rows).groupBy("brand").agg(F.avg("price").alias("p"))
    predicted = lookup(rows.where("split <> 'train'"), means, "brand", "p", "price")
    path = new_path(spark, "predictions")
    files.write_predictions(predicted, path, KEY)
    return rounded(files.read_csv(spark, path, predicted.select(KEY, "price").schema))
