"""Iterative imputation: regress every incomplete column on all others, round by round.

The fitted state is the ordered list of regressions. Filling a row means starting from the column
means and replaying that list on the row, so no intermediate table is written and no plan grows
with the rounds. Complete rows never change; their moments are taken once, and the rounds scan only
the incomplete rows, kept as one narrow table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.gram import Moments, column_means, summed_by_fold, to_matrix
from tabloom.operators.profile import any_null, col
from tabloom.operators.state import replace
from tabloom.storage import materialize

# Defaults of the Bayesian ridge regression.
RIDGE_ROUNDS, RIDGE_TOL, PRIOR = 300, 1e-3, 1e-6


def bayesian_ridge(m: Moments, target: int) -> tuple[np.ndarray, float]:
    """Coefficients (0 at the target itself) and intercept by evidence maximisation, from moments
    alone (MacKay 1992; Tipping 2001)."""
    p = len(m.sums)
    others = [i for i in range(p) if i != target]
    c = m.centred
    xx, xy, yy = c[np.ix_(others, others)], c[others, target], c[target, target]
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    turned = vectors.T @ xy
    noise = 1.0 / (yy / m.n + np.finfo(float).eps)
    weight = 1.0
    last = None
    for _ in range(RIDGE_ROUNDS):
        scaled = turned / (values + weight / noise)
        coef = vectors @ scaled
        error = max(yy - 2 * coef @ xy + coef @ xx @ coef, 0.0)
        used = np.sum(noise * values / (weight + noise * values))
        weight = (used + 2 * PRIOR) / (coef @ coef + 2 * PRIOR)
        noise = (m.n - used + 2 * PRIOR) / (error + 2 * PRIOR)
        if last is not None and np.abs(last - coef).sum() < RIDGE_TOL:
            break
        last = coef
    coef = vectors @ (turned / (values + weight / noise))
    full = np.zeros(p)
    full[others] = coef
    return full, float(m.means[target] - full @ m.means)


def replay(x: np.ndarray, means: np.ndarray, steps: list) -> np.ndarray:
    """Fill NaN with the means, then apply the regressions in order to the missing cells."""
    missing = np.isnan(x)
    filled = np.where(missing, means, x)
    for target, coef, intercept in steps:
        rows = missing[:, target]
        if rows.any():
            filled[rows, target] = filled[rows] @ np.asarray(coef) + intercept
    return filled


def _with_observed(x, means, steps, target):
    """Replayed rows; NaN where the target was missing, so that such rows are skipped."""
    filled = replay(x, means, steps)
    filled[np.isnan(x[:, target])] = np.nan
    return filled


def _largest_change(df: DataFrame, cols, means, before: list, after: list) -> float:
    names = [f"x{i}" for i in range(len(cols))]

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0.0
        for b in batches:
            x = to_matrix(b, names)
            if len(x):
                gap = np.abs(replay(x, means, after) - replay(x, means, before))
                top = max(top, float(gap.max()))
        yield pa.RecordBatch.from_arrays([pa.array([top])], names=["top"])

    data = df.select(*[col(c).cast("double").alias(n) for c, n in zip(cols, names)])
    return data.mapInArrow(change, "top double").agg(F.max("top")).first()[0] or 0.0


def fit(train: DataFrame, cols: list[str], max_iter: int = 10, tol: float = 1e-3) -> dict:
    """{"columns", "means", "steps", "rounds"} with one step per column and round."""
    row = train.agg(
        *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.max(F.abs(col(c))).alias(f"t{i}") for i, c in enumerate(cols)],
    ).first()
    top = max(row[f"t{i}"] or 0.0 for i in range(len(cols)))
    means = column_means(train, cols)
    todo = sorted((i for i in range(len(cols)) if row[f"n{i}"]), key=lambda i: (row[f"n{i}"], i))
    steps: list = []
    state = {"columns": cols, "means": means.tolist(), "steps": steps, "rounds": 0}
    if not todo:
        return state

    complete = train.dropna(subset=cols)
    base = summed_by_fold(complete, cols, None, _same, means).get(0)
    incomplete = materialize(train.where(any_null(cols)).select(*[col(c) for c in cols]), "incomplete")
    for round_no in range(max_iter):
        before = list(steps)
        for target in todo:
            rows = partial(_with_observed, means=means, steps=list(steps), target=target)
            extra = summed_by_fold(incomplete, cols, None, rows, means).get(0)
            total = base if extra is None else extra if base is None else base + extra
            coef, intercept = bayesian_ridge(total, target)
            steps.append([target, coef.tolist(), intercept])
        state["rounds"] = round_no + 1
        if _largest_change(incomplete, cols, means, before, steps) < tol * top:
            break
    return state


def _same(x: np.ndarray) -> np.ndarray:
    return x


def apply(df: DataFrame, state: dict) -> DataFrame:
    """Fill the state's columns; all other columns pass through."""
    cols, means, steps = state["columns"], np.asarray(state["means"]), state["steps"]
    if not steps:
        fill = {c: F.coalesce(col(c).cast("double"), F.lit(float(m))) for c, m in zip(cols, means)}
        return df.select(*replace(df, fill))

    @F.pandas_udf("array<double>")
    def filled(packed: pd.Series) -> pd.Series:
        held = packed.notna().to_numpy()
        out = pd.Series([None] * len(packed), dtype=object)
        if held.any():
            x = np.vstack(packed[held].to_numpy()).astype(float)
            out[held] = pd.Series(list(replay(x, means, steps)), index=out.index[held])
        return out

    # Complete rows reach the function as NULL and keep their own values.
    packed = F.when(any_null(cols), F.array(*[col(c).cast("double") for c in cols]))
    out = df.withColumn("__filled", filled(packed))
    new = {c: F.coalesce(col(c).cast("double"), F.col("__filled")[i]) for i, c in enumerate(cols)}
    return out.select(*replace(df, new))
