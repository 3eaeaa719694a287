"""File sources and stage sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Raw car file: column names and types as the source file holds them.
RAW_CAR_SCHEMA = T.StructType(
    [
        T.StructField("carID", T.LongType(), True),
        T.StructField("Brand", T.StringType(), True),
        T.StructField("model", T.StringType(), True),
        T.StructField("year", T.DoubleType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("transmission", T.StringType(), True),
        T.StructField("mileage", T.DoubleType(), True),
        T.StructField("fuelType", T.StringType(), True),
        T.StructField("tax", T.DoubleType(), True),
        T.StructField("mpg", T.DoubleType(), True),
        T.StructField("engineSize", T.DoubleType(), True),
        T.StructField("paintQuality%", T.DoubleType(), True),
        T.StructField("previousOwners", T.DoubleType(), True),
        T.StructField("hasDamage", T.DoubleType(), True),
    ]
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere in the engine; NaN would compare and average as a number."""

    def fix(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), c).alias(field.name)
        return c

    return df.select(*[fix(f) for f in df.schema.fields])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give a scan with fewer splits than cores one task per core; a larger scan is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; columns are matched by name, not by position."""
    header = spark.read.option("header", True).csv(path).columns
    by_name = {f.name: f for f in schema.fields}
    unknown = [h for h in header if h not in by_name]
    if unknown:
        raise ValueError(f"columns without a declared type: {unknown}")
    ordered = T.StructType([by_name[h] for h in header])
    df = spark.read.schema(ordered).option("header", True).option("mode", "FAILFAST").csv(path)
    return nan_to_null(df)


def check_key(df: DataFrame, key: str) -> DataFrame:
    """Raise unless `key` is unique and never null; returns the frame unchanged."""
    by_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = by_key.where(F.col(key).isNull() | (F.col("n") > 1)).limit(5).collect()
    if bad:
        raise ValueError(f"{key} is not a key, for example {[r[key] for r in bad]}")
    return df


def read_keyed(
    spark: SparkSession, path: str, key: str, schema: T.StructType | None = None
) -> DataFrame:
    """Source whose rows are identified by `key`: CSV when a schema is given, else Parquet."""
    df = read_csv(spark, path, schema) if schema is not None else read_table(spark, path)
    return check_key(df, key)


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Stage sink."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown stage format: {fmt}")


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """Train and validation rows, features with target, in one write partitioned by `split`."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_predictions(
    predicted: DataFrame, path: str, key: str, price: str = "price", fmt: str = "csv"
) -> None:
    """Prediction sink: the key and the predicted price, nothing else."""
    write_stage(predicted.select(key, price), path, fmt)
