"""Composite preprocessing: outliers, imputer, encoder, scaler as one pipeline."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.param import TypeConverters as TC
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.numeric import round_half_even, sentinel_to_null
from tabloom.operators.encode import Encoder
from tabloom.operators.impute import MissingValues
from tabloom.operators.outliers import Outliers
from tabloom.operators.scale import Scaler
from tabloom.operators.state import Stage, StateModel, param
from tabloom.sources.cars import METRIC


def preprocessor(outliers=None, imputer=None, encoder=None, scaler=None) -> Pipeline:
    """The four stages in the class order; each may be replaced by another stage.

    Methods that drop rows by a model need complete rows and so belong after the imputer: pass them
    in a Pipeline of your own order.
    """
    return Pipeline(stages=[
        outliers or Outliers(),
        imputer or MissingValues(keep=["price"]),
        encoder or Encoder(),
        scaler or Scaler(),
    ])


class TidyWhole(Stage):
    """Rounds whole-number columns half to even and turns sentinel texts into NULL."""

    whole = param("whole", "columns rounded to whole numbers", TC.toListString)
    column = param("column", "text column with a sentinel", TC.toString)
    sentinel = param("sentinel", "text that means missing", TC.toString)
    DEFAULTS = dict(whole=[], column="transmission", sentinel="Unknown")

    def _fit(self, train: DataFrame) -> "TidyModel":
        return TidyModel({k: self.get(k) for k in ("whole", "column", "sentinel")})


class TidyModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        n = self.numbers
        new = {c: round_half_even(F.col(c)) for c in n["whole"]}
        new[n["column"]] = sentinel_to_null(F.col(n["column"]), n["sentinel"])
        return df.withColumns(new)


def car_preprocessor(
    key: str = "car_id", brand: str = "brand", numeric: str = "knn_brandwise", scaler: str = "robust"
) -> Pipeline:
    """The order of the notebooks: fill numbers by nearest cars of the brand, tidy, fill words by the
    brand's mode, cap, encode, scale the numbers. Every stage learns from the rows it is fitted on."""
    return Pipeline(stages=[
        MissingValues(method=numeric, columns=METRIC, key=key, group=brand),
        TidyWhole(whole=["previous_owners"]),
        MissingValues(method="group_mode", group=brand, columns=["model", "transmission", "fuel_type"]),
        Outliers(method="IQR", severeColumns=["car_age", "mileage"], moderateColumns=["tax", "mpg"]),
        Encoder(method="onehot_named", columns=["fuel_type", "transmission"], leaveOut=["Other"]),
        Encoder(method="hybrid", group=brand, value="model"),
        Scaler(method=scaler, columns=METRIC),
    ])
