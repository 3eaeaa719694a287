"""Fitted state: a few numbers as JSON plus tables as Parquet, saved and loaded together."""

from __future__ import annotations

import json

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReader,
    MLWritable,
    MLReadable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession

from tabloom.operators.profile import col


def param(name: str, doc: str, kind=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, kind)


def one_of(*allowed: str):
    """Type converter for a name out of a fixed list, case-insensitive."""
    by_lower = {a.lower(): a for a in allowed}

    def convert(value):
        found = by_lower.get(str(value).lower())
        if found is None:
            raise ValueError(f"{value!r} is not one of {', '.join(allowed)}")
        return found

    return convert


class Stage(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator with keyword parameters. Subclasses name defaults in `DEFAULTS`."""

    DEFAULTS: dict = {}

    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**{k: v for k, v in self.DEFAULTS.items() if v is not None})
        unknown = [k for k in kwargs if not self.hasParam(k)]
        if unknown:
            raise TypeError(f"{type(self).__name__} has no parameter {unknown}")
        self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def get(self, name: str):
        p = self.getParam(name)
        return self.getOrDefault(p) if self.isDefined(p) else None


class _StateWriter(MLWriter):
    def __init__(self, instance: "StateModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        extra = {"numbers": json.loads(json.dumps(m.numbers)), "tables": sorted(m.tables)}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        for name, table in m.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> "StateModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {t: self.sparkSession.read.parquet(f"{path}/tables/{t}") for t in meta["tables"]}
        model = self.cls(meta["numbers"], tables)
        model._resetUid(meta["uid"])
        return model


class StateModel(Model, MLWritable, MLReadable):
    """Model made of `numbers` (JSON values) and `tables` (DataFrames)."""

    def __init__(self, numbers: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.numbers = numbers or {}
        self.tables = tables or {}

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


def attach(df: DataFrame, state: DataFrame, on: str, values: list[str]) -> DataFrame:
    """Left-join state columns on a group; the state holds each group once."""
    return df.join(state.select(col(on), *[col(v) for v in values]), on, "left")


def replace(df: DataFrame, new: dict[str, Column]) -> list[Column]:
    """Select list that keeps order and replaces the named columns."""
    return [(new[c] if c in new else col(c)).alias(c) for c in df.columns]
