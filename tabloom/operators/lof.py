"""Local outlier factor in novelty mode (Breunig et al. 2000) over the exact kNN join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.knn import ANY, _points, _ranges, build_donors, nearest, whole_key
from tabloom.operators.profile import any_null, col
from tabloom.operators.quantiles import exact_quantiles
from tabloom.operators.state import StateModel
from tabloom.storage import materialize

TINY = 1e-10  # fixed value: keeps the density of repeated points finite


def _density(found: DataFrame, reach: DataFrame) -> DataFrame:
    """(id, density): inverse mean reachability distance to the neighbours."""
    d = F.greatest(F.col("kdist"), F.sqrt("d2"))
    joined = found.join(reach.select(F.col("id").alias("donor"), "kdist"), "donor")
    return joined.groupBy("id").agg((1.0 / (F.avg(d) + TINY)).alias("density"))


def _factor(found: DataFrame, own: DataFrame, donors: DataFrame) -> DataFrame:
    """(id, score): minus the mean neighbour density over the row's own."""
    named = donors.select(F.col("id").alias("donor"), F.col("density").alias("theirs"))
    mean = found.join(named, "donor").groupBy("id").agg(F.avg("theirs").alias("theirs"))
    return mean.join(own, "id").select("id", (-F.col("theirs") / F.col("density")).alias("score"))


def _receivers(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return _points(df, key, None, cols).withColumn("target", F.lit(ANY))


def fit(train: DataFrame, key: str, cols: list[str], k: int, contamination: float) -> "LofModel":
    """Rows need every model column; impute first, rows with a NULL are left out of the fit."""
    present, own = whole_key(train.where(~any_null(cols)), key)
    points = _points(present, own, None, cols)
    ranges = _ranges(points, len(cols))
    donors = build_donors(points, ranges, k + 1)
    found = materialize(nearest(_receivers(present, own, cols), donors, ranges, k, exclude_self=True), "near")
    reach = found.groupBy("id").agg(F.sqrt(F.max("d2")).alias("kdist"))
    state = reach.join(_density(found, reach), "id")
    state = materialize(state, "density")
    scores = _factor(found, state.select("id", "density"), state)
    cut = exact_quantiles(scores, {"score": F.col("score")}, [contamination])["score"][0]
    numbers = {"key": key, "columns": cols, "k": k, "ranges": ranges, "cut": cut}
    return LofModel(numbers, {"donors": donors, "state": state})


class LofModel(StateModel):
    """Scores rows as new points against the training rows and keeps those at or above the cut."""

    def scores(self, df: DataFrame) -> DataFrame:
        """(id, score): id is the key."""
        n = self.numbers
        present, key = whole_key(df.where(~any_null(n["columns"])), n["key"])
        found = nearest(_receivers(present, key, n["columns"]), self.tables["donors"], n["ranges"], n["k"])
        found = materialize(found, "near")
        state = self.tables["state"]
        scored = _factor(found, _density(found, state), state)
        if key == n["key"]:
            return scored
        names = present.select(F.col(key).alias("id"), col(n["key"]).alias("__name"))
        return scored.join(names, "id").select(F.col("__name").alias("id"), "score")

    def _transform(self, df: DataFrame) -> DataFrame:
        """Rows with a missing model column cannot be scored and stay."""
        gone = self.scores(df).where(F.col("score") < self.numbers["cut"])
        keys = materialize(gone.select(F.col("id").alias("__gone")), "outliers")
        return df.join(keys, col(self.numbers["key"]) == F.col("__gone"), "left_anti")
