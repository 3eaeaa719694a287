"""Second moments of numeric columns in one pass.

Each task multiplies its batches into one small matrix per fold; Spark sums the matrices. What
reaches the driver is (p + 1)^2 numbers per fold, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import col


@dataclass
class Moments:
    """Moments of the columns around `shift`: n, sums and cross products."""

    n: float
    sums: np.ndarray
    cross: np.ndarray
    shift: np.ndarray

    def __add__(self, o: "Moments") -> "Moments":
        return Moments(self.n + o.n, self.sums + o.sums, self.cross + o.cross, self.shift)

    def __sub__(self, o: "Moments") -> "Moments":
        return Moments(self.n - o.n, self.sums - o.sums, self.cross - o.cross, self.shift)

    @property
    def means(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    @property
    def centred(self) -> np.ndarray:
        """Cross products around the means."""
        return self.cross - np.outer(self.sums, self.sums) / self.n

    def pick(self, at: list[int]) -> "Moments":
        at = np.asarray(at)
        return Moments(self.n, self.sums[at], self.cross[np.ix_(at, at)], self.shift[at])


def column_means(df: DataFrame, cols: list[str]) -> np.ndarray:
    row = df.agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return np.array([0.0 if v is None else v for v in row], dtype=float)


def to_matrix(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Rows of an Arrow batch as doubles, NULL as NaN."""
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return np.column_stack([a.cast(pa.float64()).to_numpy(zero_copy_only=False) for a in arrays])


def summed_by_fold(
    df: DataFrame, cols: list[str], fold: Column | None, rows: Callable[[np.ndarray], np.ndarray],
    shift: np.ndarray,
) -> dict[int, Moments]:
    """Moments per fold of `rows(matrix)`; rows with a NaN left after `rows` are skipped."""
    width = len(shift)
    names = [f"x{i}" for i in range(len(cols))]
    data = df.select(
        (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
        *[col(c).cast("double").alias(n) for c, n in zip(cols, names)],
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = rows(to_matrix(batch, names)) - shift
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            ok = ~np.isnan(x).any(axis=1)
            for f in np.unique(folds[ok]):
                part = x[ok & (folds == f)]
                one = np.column_stack([np.ones(len(part)), part])
                held[int(f)] = held.get(int(f), 0) + one.T @ one
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()),
                 pa.array([m.ravel() for m in held.values()], pa.list_(pa.float64()))],
                names=["fold", "cells"],
            )

    parts = data.mapInArrow(partial, "fold int, cells array<double>")
    summed = (
        parts.select("fold", F.posexplode("cells").alias("at", "cell"))
        .groupBy("fold", "at").agg(F.sum("cell").alias("cell"))
        .toArrow()
    )
    out = {}
    fold_of, at, cell = (summed.column(i).to_numpy() for i in range(3))
    for f in np.unique(fold_of):
        full = np.zeros((width + 1) ** 2)
        mine = fold_of == f
        full[at[mine]] = cell[mine]
        full = full.reshape(width + 1, width + 1)
        out[int(f)] = Moments(full[0, 0], full[0, 1:], full[1:, 1:], shift)
    return out


def moments(
    df: DataFrame, cols: list[str], fold: Column | None = None, shift: np.ndarray | None = None
) -> dict[int, Moments]:
    """Moments per fold over rows without NULL; fold 0 holds everything when none is given."""
    if shift is None:
        shift = column_means(df, cols)
    return summed_by_fold(df, cols, fold, _as_is, shift)


def _as_is(x: np.ndarray) -> np.ndarray:
    return x


def pairwise_correlations(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson matrix in one pass, each pair over the rows where both are present; NaN where one of the two
    does not vary there, which its smallest and largest value tell exactly."""
    p, shift = len(cols), column_means(df, cols)
    names = [f"x{i}" for i in range(p)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, low, high = np.zeros((4, p, p)), np.full((p, p), np.inf), np.full((p, p), -np.inf)
        for batch in batches:
            values = to_matrix(batch, names)
            there = ~np.isnan(values)
            for j in range(p):  # of every column, over the rows where column j is present
                if there[:, j].any():
                    part = values[there[:, j]]
                    low[:, j] = np.fmin(low[:, j], np.fmin.reduce(part, axis=0))
                    high[:, j] = np.fmax(high[:, j], np.fmax.reduce(part, axis=0))
            x, here = np.nan_to_num(values - shift), there.astype(float)
            sums += np.stack([here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x])
        cells = np.concatenate([sums.ravel(), low.ravel(), high.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([cells], pa.list_(pa.float64()))], names=["cells"])

    data = df.select(*[col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    merged = (
        data.mapInArrow(partial, "cells array<double>")
        .select(F.posexplode("cells").alias("at", "cell")).groupBy("at")
        .agg(F.sum("cell").alias("sum"), F.min("cell").alias("low"), F.max("cell").alias("high")).orderBy("at").toArrow()
    )
    total, least, most = (merged.column(c).to_numpy() for c in ("sum", "low", "high"))
    n, s, ss, xy = total[:4 * p * p].reshape(4, p, p)
    varies = least[4 * p * p:5 * p * p] < most[5 * p * p:]
    with np.errstate(divide="ignore", invalid="ignore"):
        var = np.where(varies.reshape(p, p), np.maximum(ss - s * s / n, 0.0), 0.0)
        size = np.sqrt(var * var.T)
        return np.where(size > 0, (xy - s * s.T / n) / size, np.nan)  # dust over zero is no correlation
