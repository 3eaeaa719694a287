"""Filling missing values from statistics of the training rows."""

from __future__ import annotations

from pyspark.ml.param import TypeConverters as TC
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import iterative, knn
from tabloom.operators.distributions import mode_by_group, mode_global
from tabloom.operators.profile import col, columns_by_type
from tabloom.operators.quantiles import columns_of, exact_quantiles
from tabloom.operators.state import Stage, StateModel, attach, one_of, param, replace
from tabloom.storage import settle

STRATEGIES = ("mean", "median", "most_frequent", "constant")


def group_modes(train: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """One row per group: the most frequent value of every column."""
    long = mode_by_group(train.where(col(group).isNotNull()), group, cols)
    wide = long.groupBy(col(group)).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("mode"))).alias(f"{c}_mode") for c in cols]
    )
    return settle(wide, "modes")


def global_modes(train: DataFrame, cols: list[str]) -> dict[str, str]:
    return {r["column_name"]: r["mode"] for r in mode_global(train, cols).collect()}


def fill_group_modes(
    df: DataFrame, modes: DataFrame, group: str, cols: list[str], fallback: dict[str, str]
) -> DataFrame:
    """Fill from the row's group; a group unknown in training uses the overall mode."""
    joined = attach(df, modes, group, [f"{c}_mode" for c in cols])
    new = {c: F.coalesce(col(c), F.col(f"{c}_mode"), F.lit(fallback.get(c))) for c in cols}
    return joined.select(*replace(df, new))


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Fill NULL by one value per column; a whole-number column filled by a fraction turns double."""
    types = dict(df.dtypes)
    new = {}
    for c, v in values.items():
        if v is not None:
            kind = "double" if isinstance(v, float) and not v.is_integer() else types[c]
            new[c] = F.coalesce(col(c).cast(kind), F.lit(v).cast(kind))
    return df.select(*replace(df, new))


def fill_statistics(train: DataFrame, cols: list[str], strategy: str, fill_value=None) -> dict:
    """The value each column is filled with. Mean and median are for numbers only."""
    one_of(*STRATEGIES)(strategy)
    numeric = columns_by_type(train, numeric=True)
    if strategy in ("mean", "median") and set(cols) - set(numeric):
        raise ValueError(f"{strategy} needs numeric columns, not {sorted(set(cols) - set(numeric))}")
    if strategy == "mean":
        row = train.agg(*[F.avg(col(c)).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "median":
        return {c: q[0] for c, q in exact_quantiles(train, columns_of(cols), [0.5]).items()}
    if strategy == "constant":
        return {c: (0 if c in numeric else "missing_value") if fill_value is None else fill_value
                for c in cols}
    # Values are compared as numbers or as text according to the column type.
    out = {}
    for c in cols:
        counted = train.where(col(c).isNotNull()).groupBy(col(c)).agg(F.count(F.lit(1)).alias("n"))
        out[c] = counted.agg(F.min_by(col(c), F.struct(-F.col("n"), col(c)))).first()[0]
    return out


class MissingValues(Stage):
    """Imputer by name: simple, knn, knn_brandwise, iterative or group_mode.

    Without `columns` the numeric columns are filled; simple most_frequent and constant fill every
    column but the ones in `keep`, group_mode the text columns.
    """

    method = param("method", "simple, knn, knn_brandwise, iterative, group_mode",
                   one_of("simple", "knn", "knn_brandwise", "iterative", "group_mode"))
    strategy = param("strategy", "statistic of the simple method", one_of(*STRATEGIES))
    fillValue = param("fillValue", "constant of the simple method")
    neighbors = param("neighbors", "donors of the knn methods", TC.toInt)
    columns = param("columns", "columns to fill", TC.toListString)
    keep = param("keep", "columns that are never filled or used, such as key and label",
                 TC.toListString)
    key = param("key", "row key", TC.toString)
    group = param("group", "group column", TC.toString)
    maxIter = param("maxIter", "rounds of the iterative method", TC.toInt)
    tol = param("tol", "stop tolerance of the iterative method", TC.toFloat)

    DEFAULTS = dict(method="simple", strategy="mean", neighbors=5, keep=[], key="car_id",
                    group="brand", maxIter=10, tol=1e-3)

    def _columns(self, train: DataFrame) -> list[str]:
        chosen = self.get("columns")
        if chosen is not None:
            return chosen
        left_out = set(self.get("keep")) | {self.get("key")}
        method, strategy = self.get("method"), self.get("strategy")
        numeric = columns_by_type(train, numeric=True)
        if method == "group_mode":
            left_out.add(self.get("group"))
            pool = columns_by_type(train, numeric=False)
        elif method == "simple" and strategy in ("most_frequent", "constant"):
            pool = train.columns
        else:
            pool = numeric
        return [c for c in pool if c not in left_out]

    def _fit(self, train: DataFrame) -> StateModel:
        method, cols = self.get("method"), self._columns(train)
        if method == "simple":
            values = fill_statistics(train, cols, self.get("strategy"), self.get("fillValue"))
            return FilledModel({"values": values})
        if method == "group_mode":
            group = self.get("group")
            numbers = {"group": group, "columns": cols,
                       "fallback": global_modes(train, [group, *cols])}
            return GroupModeModel(numbers, {"modes": group_modes(train, group, cols)})
        if method == "iterative":
            fitted = iterative.fit(train, cols, self.get("maxIter"), self.get("tol"))
            return IterativeModel(fitted)
        group = self.get("group") if method == "knn_brandwise" else None
        return knn.fit_imputer(train, self.get("key"), cols, self.get("neighbors"), group)


class FilledModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return fill_values(df, self.numbers["values"])


class GroupModeModel(StateModel):
    """Fills a missing group with the training mode first, then each column from its group."""

    def _transform(self, df: DataFrame) -> DataFrame:
        n = self.numbers
        df = fill_values(df, {n["group"]: n["fallback"][n["group"]]})
        return fill_group_modes(df, self.tables["modes"], n["group"], n["columns"], n["fallback"])


class IterativeModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return iterative.apply(df, self.numbers)
