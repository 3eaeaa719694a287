"""Capping by quartiles or deviations, and the stage that also removes rows by a model."""

from __future__ import annotations

from pyspark.ml.param import TypeConverters as TC
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numeric import clip
from tabloom.operators import iforest, lof
from tabloom.operators.profile import col
from tabloom.operators.quantiles import columns_of, exact_quantiles
from tabloom.operators.state import Stage, StateModel, one_of, param, replace

MODERATE, SEVERE = 1.5, 3.0
METHODS = ("z-score", "IQR", "Isolation_Forest", "LOF")


def iqr_bounds(
    train: DataFrame, moderate: list[str], severe: list[str]
) -> dict[str, list[float]]:
    """{column: [low, high]}; a column in both lists gets the moderate bounds, which are tighter."""
    cols = list(dict.fromkeys([*moderate, *severe]))
    q = exact_quantiles(train, columns_of(cols), [0.25, 0.75])
    out = {}
    for c in cols:
        q1, q3 = q[c]
        if q1 is not None:
            reach = (MODERATE if c in moderate else SEVERE) * (q3 - q1)
            out[c] = [q1 - reach, q3 + reach]
    return out


def zscore_bounds(train: DataFrame, cols: list[str], threshold: float) -> dict[str, list[float]]:
    row = train.agg(
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_samp(col(c)).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        if m is not None and s is not None:
            out[c] = [m - threshold * s, m + threshold * s]
    return out


def cap(df: DataFrame, bounds: dict[str, list[float]]) -> DataFrame:
    """Clip every bounded column; NULL stays NULL."""
    return df.select(*replace(df, {
        c: clip(col(c).cast("double"), float(lo), float(hi)) for c, (lo, hi) in bounds.items()
    }))


class Outliers(Stage):
    """z-score and IQR cap values, Isolation_Forest and LOF drop rows."""

    method = param("method", ", ".join(METHODS), one_of(*METHODS))
    moderateColumns = param("moderateColumns", "capped at 1.5 IQR", TC.toListString)
    severeColumns = param("severeColumns", "capped at 3 IQR", TC.toListString)
    threshold = param("threshold", "deviations of the z-score cap", TC.toFloat)
    zColumns = param("zColumns", "columns of the z-score cap", TC.toListString)
    modelColumns = param("modelColumns", "columns of the row-removing methods", TC.toListString)
    contamination = param("contamination", "share of training rows called outliers", TC.toFloat)
    neighbors = param("neighbors", "neighbours of LOF", TC.toInt)
    seed = param("seed", "seed of the isolation forest", TC.toInt)
    key = param("key", "row key", TC.toString)
    DEFAULTS = dict(method="z-score", moderateColumns=[], severeColumns=[], threshold=3.0,
                    zColumns=[], modelColumns=[], contamination=0.05, neighbors=20, seed=42,
                    key="car_id")

    def _fit(self, train: DataFrame) -> StateModel:
        method, cols = self.get("method"), self.get("modelColumns")
        if method == "IQR":
            bounds = iqr_bounds(train, self.get("moderateColumns"), self.get("severeColumns"))
            return CapModel({"bounds": bounds})
        if method == "z-score":
            return CapModel({"bounds": zscore_bounds(train, self.get("zColumns"), self.get("threshold"))})
        if method == "Isolation_Forest":
            return iforest.fit(train, self.get("key"), cols, self.get("contamination"), self.get("seed"))
        return lof.fit(train, self.get("key"), cols, self.get("neighbors"), self.get("contamination"))


class CapModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return cap(df, self.numbers["bounds"])
