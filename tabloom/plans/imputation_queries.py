"""Imputation queries: fitted on the train rows, applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.functions.numeric import round_half_even, sentinel_to_null
from tabloom.operators import impute as I
from tabloom.plans import frames
from tabloom.plans.frames import rounded
from tabloom.plans.registry import query
from tabloom.plans.sqltext import mode_cte, r, register_cte, sql
from tabloom.sources.cars import KEY, METRIC
from tabloom.storage import materialize

WORDS = ["model", "transmission", "fuel_type"]

register_cte("known", """SELECT * REPLACE (nullif(transmission, 'Unknown') AS transmission)
    FROM split_cars""", ["split_cars"])
register_cte("known_train", "SELECT * FROM known WHERE split = 'train'", ["known"])


def known(spark, sf):
    """Split rows with the unknown transmission as missing."""
    rows = frames.split_cars(spark, sf)
    return rows.withColumn("transmission", sentinel_to_null(F.col("transmission")))


def _train(df):
    return df.where(F.col("split") == "train")


def _modes(source: str) -> dict[str, str]:
    return {f"m_{c}": mode_cte(source, "brand", c) for c in WORDS}


def _filled(source: str) -> str:
    joins = " ".join(f"LEFT JOIN m_{c} ON m_{c}.brand = k.brand" for c in WORDS)
    cols = ", ".join(f"coalesce(k.{c}, m_{c}.mode) AS {c}" for c in WORDS)
    return f"SELECT k.car_id, k.brand, {cols} FROM {source} k {joins}"


@query("impute_mode_group", sql(_filled("known_train"), "known_train", **_modes("known_train")))
def impute_mode_group(spark, sf):
    rows = _train(known(spark, sf)).select(KEY, "brand", *WORDS)
    return I.fill_group_modes(rows, I.group_modes(rows, "brand", WORDS), "brand", WORDS, {})


@query("impute_mode_apply", sql(_filled("known"), "known", "known_train", **_modes("known_train")))
def impute_mode_apply(spark, sf):
    rows = known(spark, sf)
    stage = I.MissingValues(method="group_mode", group="brand", columns=WORDS)
    return stage.fit(_train(rows)).transform(rows).select(KEY, "brand", *WORDS)


@query("impute_mode_global", sql(
    "SELECT car_id, coalesce(brand, (SELECT mode FROM m)) AS brand FROM clean", "clean", "train",
    m=mode_cte("train", None, "brand")))
def impute_mode_global(spark, sf):
    mode = I.global_modes(frames.train(spark, sf), ["brand"])
    return I.fill_values(frames.cleaned(spark, sf), mode).select(KEY, "brand")


def _simple_sql(value: str, cols: list[str]) -> str:
    out = ", ".join(f"{r(f'coalesce(CAST(b.{c} AS DOUBLE), {value.format(c=c)})', c)}" for c in cols)
    return f"SELECT b.car_id, {out} FROM split_cars b"


def _simple(spark, sf, strategy: str, cols: list[str], **kw):
    rows = frames.split_cars(spark, sf)
    rows = rows.select(KEY, "split", *[F.col(c).cast("double").alias(c) for c in cols])
    stage = I.MissingValues(method="simple", strategy=strategy, columns=cols, **kw)
    return rounded(stage.fit(_train(rows)).transform(rows).select(KEY, *cols))


@query("impute_mean", sql(_simple_sql("(SELECT avg({c}) FROM train)", METRIC), "split_cars", "train"))
def impute_mean(spark, sf):
    return _simple(spark, sf, "mean", METRIC)


@query("impute_median", sql(_simple_sql("(SELECT quantile_cont({c}, 0.5) FROM train)", METRIC), "split_cars", "train"))
def impute_median(spark, sf):
    return _simple(spark, sf, "median", METRIC)


_FREQUENT = ["car_age", "mpg", "previous_owners"]


@query("impute_most_frequent", sql(
    _simple_sql("(SELECT mode FROM f_{c})", _FREQUENT), "split_cars", "train",
    **{f"f_{c}": mode_cte("train", None, c) for c in _FREQUENT}))
def impute_most_frequent(spark, sf):
    return _simple(spark, sf, "most_frequent", _FREQUENT)


@query("impute_constant", sql(_simple_sql("-1", METRIC), "split_cars"))
def impute_constant(spark, sf):
    return _simple(spark, sf, "constant", METRIC, fillValue=-1.0)


def numbers(spark, sf):
    rows = frames.split_cars(spark, sf)
    rows = rows.select(KEY, "brand", "split", *[F.col(c).cast("double").alias(c) for c in METRIC])
    return materialize(rows, "numbers")  # read by several jobs of the fit


def knn_stage(**kw) -> I.MissingValues:
    return I.MissingValues(method="knn_brandwise", columns=METRIC, neighbors=5, **kw)


@query("impute_knn_group")
def impute_knn_group(spark, sf):
    train = _train(numbers(spark, sf)).drop("split")
    filled = knn_stage().fit(train).transform(train)
    return filled.withColumn("previous_owners", round_half_even(F.col("previous_owners")))


def fill_by_imputed_train(rows):
    """Train rows filled from themselves; all others from the filled train rows."""
    train = _train(rows)
    done = materialize(knn_stage().fit(train).transform(train).withColumn(
        "previous_owners", round_half_even(F.col("previous_owners"))), "imputed")
    rest = knn_stage().fit(done).transform(rows.where(F.col("split") != "train"))
    rest = rest.withColumn("previous_owners", round_half_even(F.col("previous_owners")))
    return done.unionByName(rest)


@query("impute_knn_group_apply")
def impute_knn_group_apply(spark, sf):
    return fill_by_imputed_train(numbers(spark, sf))


def _nearest_sql(target: str) -> str:
    """Mean of the five nearest train rows that have the target, over the columns both rows have."""
    gaps = " + ".join(f"coalesce((q.{c} - d.{c}) * (q.{c} - d.{c}), 0.0::DOUBLE)" for c in METRIC)
    shared = " + ".join(f"CAST(q.{c} IS NOT NULL AND d.{c} IS NOT NULL AS INTEGER)" for c in METRIC)
    return f"""SELECT id, list_avg(list_transform(near, lambda x: x.v)) AS fill FROM (
        SELECT q.car_id AS id, min({{'d': ({gaps}) * ({len(METRIC)}.0::DOUBLE / ({shared})), 'i': d.car_id, 'v': d.{target}}}, 5) AS near
        FROM numbers q JOIN numbers d ON q.{target} IS NULL AND d.{target} IS NOT NULL AND d.split = 'train' AND {shared} > 0
        GROUP BY q.car_id)"""


@query("impute_knn", sql(
    "SELECT car_id, brand, split, " + ", ".join(r(f"coalesce({c}, f_{c}.fill, (SELECT avg({c}) FROM train))", c) for c in METRIC)
    + " FROM numbers " + " ".join(f"LEFT JOIN f_{c} ON f_{c}.id = car_id" for c in METRIC), "split_cars", "train",
    numbers="SELECT car_id, brand, split, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in METRIC) + " FROM split_cars",
    **{f"f_{c}": _nearest_sql(c) for c in METRIC}))
def impute_knn(spark, sf):
    rows = numbers(spark, sf)
    stage = I.MissingValues(method="knn", columns=METRIC, neighbors=5)
    return rounded(stage.fit(_train(rows)).transform(rows))


@query("impute_iterative")
def impute_iterative(spark, sf):
    rows = numbers(spark, sf)
    return I.MissingValues(method="iterative", columns=METRIC).fit(_train(rows)).transform(rows)
