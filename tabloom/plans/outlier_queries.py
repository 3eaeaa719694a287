"""Outlier queries: bounds from the train rows, applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import outliers as O
from tabloom.plans import frames
from tabloom.plans.frames import rounded
from tabloom.plans.imputation_queries import numbers
from tabloom.plans.registry import query
from tabloom.plans.sqltext import r, sql
from tabloom.sources.cars import KEY

SEVERE, MODERATE = ["car_age", "mileage"], ["tax", "mpg"]


def _capped(bounds: dict[str, tuple[str, str]]) -> str:
    """Clip columns between two scalar subqueries over the train rows."""
    parts = []
    for c, (lo, hi) in bounds.items():
        parts.append(r(f"CASE WHEN s.{c} < ({lo}) THEN ({lo}) WHEN s.{c} > ({hi}) THEN ({hi}) "
                       f"ELSE CAST(s.{c} AS DOUBLE) END", c))
    return f"SELECT s.car_id, {', '.join(parts)} FROM split_cars s"


def _iqr(c: str, k: float) -> tuple[str, str]:
    q = lambda p: f"quantile_cont({c}, {p})"
    spread = f"{k} * ({q(0.75)} - {q(0.25)})"
    return f"SELECT {q(0.25)} - {spread} FROM train", f"SELECT {q(0.75)} + {spread} FROM train"


def _z(c: str, t: float) -> tuple[str, str]:
    return (f"SELECT avg({c}) - {t} * stddev_samp({c}) FROM train",
            f"SELECT avg({c}) + {t} * stddev_samp({c}) FROM train")


def _stage(spark, sf, cols: list[str], **kw):
    rows = frames.split_cars(spark, sf).select(KEY, "split", *cols)
    model = O.Outliers(**kw).fit(rows.where(F.col("split") == "train"))
    return rounded(model.transform(rows).select(KEY, *cols))


@query("cap_iqr_severe", sql(_capped({c: _iqr(c, 3) for c in SEVERE}), "split_cars", "train"))
def cap_iqr_severe(spark, sf):
    return _stage(spark, sf, SEVERE, method="IQR", severeColumns=SEVERE)


@query("cap_iqr_moderate", sql(_capped({c: _iqr(c, 1.5) for c in MODERATE}), "split_cars", "train"))
def cap_iqr_moderate(spark, sf):
    return _stage(spark, sf, MODERATE, method="IQR", moderateColumns=MODERATE)


@query("cap_iqr_lists", sql(_capped(
    {"car_age": _iqr("car_age", 3)} | {c: _iqr(c, 1.5) for c in ["tax", "mpg", "mileage"]}), "split_cars", "train"))
def cap_iqr_lists(spark, sf):
    return _stage(spark, sf, ["car_age", "tax", "mpg", "mileage"], method="IQR",
                  moderateColumns=["tax", "mpg", "mileage"], severeColumns=SEVERE)


_Z = ["mileage", "tax", "mpg", "engine_size"]


@query("cap_zscore", sql(_capped({c: _z(c, 2) for c in _Z}), "split_cars", "train"))
def cap_zscore(spark, sf):
    return _stage(spark, sf, _Z, method="z-score", zColumns=_Z, threshold=2.0)


_MODEL = ["mileage", "tax", "mpg", "engine_size"]


def _complete(spark, sf):
    """Numbers with gaps filled by the train mean, as the row-removing methods need every value."""
    from tabloom.operators.impute import MissingValues
    from tabloom.storage import materialize

    rows = numbers(spark, sf)
    stage = MissingValues(method="simple", strategy="mean", columns=_MODEL)
    filled = stage.fit(rows.where(F.col("split") == "train")).transform(rows)
    return materialize(filled.select(KEY, "split", *_MODEL), "complete")


def _removed(spark, sf, method: str):
    rows = _complete(spark, sf)
    model = O.Outliers(method=method, modelColumns=_MODEL).fit(rows.where(F.col("split") == "train"))
    return model.transform(rows)


@query("isolation_forest")
def isolation_forest(spark, sf):
    return _removed(spark, sf, "Isolation_Forest")


_LOF_ROWS = "SELECT car_id, split, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM train)) AS {c}" for c in _MODEL) + " FROM split_cars"


def _near_sql(rows: str, others: bool) -> str:
    """The 20 nearest train rows of each row, as (id, d2, donor); without itself with `others`."""
    d2 = " + ".join(f"(q.{c} - d.{c}) * (q.{c} - d.{c})" for c in _MODEL)
    return f"""SELECT id, near.d AS d2, near.i AS donor FROM (
        SELECT q.car_id AS id, unnest(min({{'d': {d2}, 'i': d.car_id}}, 20)) AS near
        FROM {rows} q JOIN complete d ON d.split = 'train' {"AND q.car_id <> d.car_id" if others else ""} GROUP BY q.car_id)"""


def _density_sql(near: str) -> str:
    return (f"SELECT n.id, 1.0::DOUBLE / (avg(greatest(k.kdist, sqrt(n.d2))) + 1e-10) AS density "
            f"FROM {near} n JOIN reach k ON k.id = n.donor GROUP BY n.id")


def _factor_sql(near: str, own: str) -> str:
    return f"""SELECT n.id, -avg(t.density) / any_value(o.density) AS score
        FROM {near} n JOIN dense t ON t.id = n.donor JOIN {own} o ON o.id = n.id GROUP BY n.id"""


@query("local_outlier_factor", sql(
    "SELECT car_id, split, " + ", ".join(r(c, c) for c in _MODEL) + """ FROM complete JOIN scores ON id = car_id
    WHERE score >= (SELECT quantile_cont(score, 0.05) FROM fitted)""", "split_cars", "train",
    complete=_LOF_ROWS, learned="SELECT * FROM complete WHERE split = 'train'",
    near=_near_sql("learned", True), reach="SELECT id, sqrt(max(d2)) AS kdist FROM near GROUP BY id",
    dense=_density_sql("near"), fitted=_factor_sql("near", "dense"), near_new=_near_sql("complete", False),
    dense_new=_density_sql("near_new"), scores=_factor_sql("near_new", "dense_new")))
def local_outlier_factor(spark, sf):
    return rounded(_removed(spark, sf, "LOF"))
