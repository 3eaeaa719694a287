"""Scaling as one projection over bounds learned from training rows."""

from __future__ import annotations

from pyspark.ml.param import TypeConverters as TC
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import col, columns_by_type
from tabloom.operators.quantiles import columns_of, exact_quantiles
from tabloom.operators.state import Stage, StateModel, attach, one_of, param, replace
from tabloom.storage import settle

METHODS = ("robust", "minmax", "standard")


def _or_one(x: float | None) -> float:
    return x if x else 1.0


def scale_statistics(train: DataFrame, cols: list[str], method: str) -> dict[str, list[float]]:
    """{column: [centre, scale]}; a zero scale becomes 1, so a constant column turns into 0."""
    one_of(*METHODS)(method)
    if method == "robust":
        q = exact_quantiles(train, columns_of(cols), [0.25, 0.5, 0.75])
        return {c: [q[c][1], _or_one(q[c][2] - q[c][0])] for c in cols if q[c][0] is not None}
    if method == "minmax":
        aggs = [f(col(c)).cast("double").alias(f"{t}{i}")
                for i, c in enumerate(cols) for t, f in (("a", F.min), ("b", F.max))]
    else:
        aggs = [f(col(c)).alias(f"{t}{i}")
                for i, c in enumerate(cols) for t, f in (("a", F.avg), ("b", F.stddev_pop))]
    row = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if a is not None:
            out[c] = [a, _or_one(b - a if method == "minmax" else b)]
    return out


def apply_scale(df: DataFrame, stats: dict[str, list[float]]) -> DataFrame:
    new = {c: (col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()}
    return df.select(*replace(df, new))


def invert_scale(df: DataFrame, stats: dict[str, list[float]]) -> DataFrame:
    new = {c: col(c) * F.lit(s) + F.lit(m) for c, (m, s) in stats.items()}
    return df.select(*replace(df, new))


def group_statistics(train: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """One row per group: mean and population deviation (1 when zero) of every column."""
    aggs = []
    for c in cols:
        sd = F.stddev_pop(col(c))
        aggs += [F.avg(col(c)).alias(f"{c}__m"), F.when(sd > 0, sd).otherwise(1.0).alias(f"{c}__s")]
    return settle(train.groupBy(col(group)).agg(*aggs), "group_scale")


def _group_columns(cols: list[str]) -> list[str]:
    return [f"{c}__{t}" for c in cols for t in ("m", "s")]


def scale_in_group(
    df: DataFrame, state: DataFrame, group: str, cols: list[str], fallback: dict[str, list[float]],
    inverse: bool = False,
) -> DataFrame:
    """Standard scaling inside each group, or its inverse; an unseen group uses overall numbers."""
    joined = attach(df, state, group, _group_columns(cols))
    new = {}
    for c in cols:
        m0, s0 = fallback.get(c, [0.0, 1.0])
        m = F.coalesce(F.col(f"`{c}__m`"), F.lit(m0))
        s = F.coalesce(F.col(f"`{c}__s`"), F.lit(s0))
        new[c] = col(c) * s + m if inverse else (col(c) - m) / s
    return joined.select(*replace(df, new))


class Scaler(Stage):
    """robust, minmax or standard by case-insensitive name; other columns pass through."""

    method = param("method", "robust, minmax or standard", one_of(*METHODS))
    columns = param("columns", "columns to scale; all numeric ones when not given", TC.toListString)
    keep = param("keep", "numeric columns left as they are", TC.toListString)
    DEFAULTS = dict(method="robust", keep=["car_id", "price"])

    def _fit(self, train: DataFrame) -> "ScalerModel":
        cols = self.get("columns")
        if cols is None:
            cols = [c for c in columns_by_type(train, numeric=True) if c not in self.get("keep")]
        return ScalerModel({"stats": scale_statistics(train, cols, self.get("method"))})


class ScalerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return apply_scale(df, self.numbers["stats"])

    def inverse(self, df: DataFrame) -> DataFrame:
        return invert_scale(df, self.numbers["stats"])
