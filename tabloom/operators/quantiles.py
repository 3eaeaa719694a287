"""Exact quantiles with linear interpolation, by narrowing.

Spark's exact `percentile` keeps every distinct value in one task, which is fine for small
inputs only. Past `DIRECT_ROWS` the order statistics are found by repeated scans: a bounded sketch
(`percentile_approx`) brackets the wanted ranks, the next scan counts what lies below and inside
the bracket and sketches the inside, until the bracket holds few rows. Every scan shuffles only
sketches and counters, and each one divides the candidates by about `ACCURACY / 4`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.storage import materialize

DIRECT_ROWS = 200_000
FINAL_ROWS = 50_000
ACCURACY = 10_000


@dataclass
class _Rank:
    """One wanted order statistic: the `rank`-th smallest (from 0) of column number `col`.

    `below` rows are at or under `low`; `inside` rows lie strictly between `low` and `high`.
    """

    col: int
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    slack: float = 0.0
    value: float | None = None

    def window(self, c: Column) -> Column:
        keep = c.isNotNull()
        if self.low is not None:
            keep = keep & (c > self.low)
        if self.high is not None:
            keep = keep & (c < self.high)
        return keep


def interpolate(low: float, high: float, at: float) -> float:
    """Value at the fractional rank `at` between its neighbours, by the formula of Spark's `percentile`."""
    below, above = math.floor(at), math.ceil(at)
    return low if below == above or low == high else (above - at) * low + (at - below) * high


def exact_quantiles(
    df: DataFrame,
    exprs: dict[str, Column],
    probs: list[float],
    direct_rows: int | None = None,
    final_rows: int | None = None,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """`{name: [quantile for each prob]}` over the non-null values of each expression."""
    direct_rows = DIRECT_ROWS if direct_rows is None else direct_rows
    final_rows = FINAL_ROWS if final_rows is None else final_rows
    names = list(exprs)
    data = df.select(*[exprs[n].cast("double").alias(f"q{i}") for i, n in enumerate(names)])
    cols = data.columns
    # several scans follow: stage the numbers alone, not the plan that made them
    data = materialize(data, "quantiles")
    counts = data.agg(*[F.count(c).alias(c) for c in cols]).first()
    if max((counts[c] for c in cols), default=0) <= direct_rows:
        row = data.agg(*[F.percentile(c, [float(p) for p in probs]).alias(c) for c in cols]).first()
        return {n: list(row[c]) if row[c] is not None else [None] * len(probs)
                for n, c in zip(names, cols)}

    wanted: dict[tuple[int, int], _Rank] = {}
    for i, c in enumerate(cols):
        for p in probs if counts[c] else []:
            at = (counts[c] - 1) * p
            for rank in (math.floor(at), math.ceil(at)):
                wanted.setdefault((i, rank), _Rank(i, rank, counts[c], slack=2.0 / accuracy))
    _narrow(data, cols, list(wanted.values()), final_rows, accuracy)

    out = {}
    for i, (n, c) in enumerate(zip(names, cols)):
        if not counts[c]:
            out[n] = [None] * len(probs)
            continue
        at = [(counts[c] - 1) * p for p in probs]
        out[n] = [
            interpolate(wanted[i, math.floor(a)].value, wanted[i, math.ceil(a)].value, a) for a in at
        ]
    return out


def _narrow(data, cols, ranks: list[_Rank], final_rows: int, accuracy: int) -> None:
    """Fill in `value` of every rank."""
    open_ranks = ranks
    while open_ranks:
        # ranks of one window share its sketch
        windows: dict[tuple, list[int]] = {}
        for j, r in enumerate(open_ranks):
            windows.setdefault((r.col, r.low, r.high), []).append(j)
        aggs = []
        for i, held in enumerate(windows.values()):
            r = open_ranks[held[0]]
            x = F.when(r.window(F.col(cols[r.col])), F.col(cols[r.col]))
            p = []
            for r in (open_ranks[j] for j in held):
                at = (r.rank - r.below) / r.inside
                p += [max(0.0, at - r.slack), min(1.0, at + 1 / r.inside + r.slack)]
            aggs.append(F.percentile_approx(x, p, accuracy).alias(f"b{i}"))
            aggs.append(F.array(F.min(x), F.max(x)).alias(f"m{i}"))
        sketch = data.agg(*aggs).first()
        bracket = [None] * len(open_ranks)
        for i, held in enumerate(windows.values()):
            for place, j in enumerate(held):
                r = open_ranks[j]
                at = (r.rank - r.below) / r.inside
                low = sketch[f"m{i}"][0] if at <= r.slack else sketch[f"b{i}"][2 * place]
                high = sketch[f"m{i}"][1] if at + 1 / r.inside + r.slack >= 1 else sketch[f"b{i}"][2 * place + 1]
                bracket[j] = (low, high)

        counted = {key: i for i, key in enumerate(dict.fromkeys((r.col, *b) for r, b in zip(open_ranks, bracket)))}
        aggs = []
        for (at_col, low, high), i in counted.items():
            c = F.col(cols[at_col])
            kinds = [c < low, c == low, (c > low) & (c < high), c == high]
            aggs += [F.count_if(kind).alias(f"n{i}_{part}") for part, kind in enumerate(kinds)]
        n = data.agg(*aggs).first()
        still, few = [], []
        for r, (low, high) in zip(open_ranks, bracket):
            under, at_low, between, at_high = (n[f"n{counted[r.col, low, high]}_{i}"] for i in range(4))
            if not under <= r.rank < under + at_low + between + at_high:
                r.slack *= 2  # the sketch missed: keep the old window and look wider
                still.append(r)
            elif r.rank < under + at_low:
                r.value = low
            elif r.rank >= under + at_low + between:
                r.value = high
            else:
                r.low, r.high, r.below, r.inside = low, high, under + at_low, between
                (few if between <= final_rows else still).append(r)
        if few:
            _pick(data, cols, few)
        open_ranks = still


def _pick(data: DataFrame, cols: list[str], ranks: list[_Rank]) -> None:
    """Read the few distinct values of all finished brackets in one job and step to the wanted ranks."""
    held = [F.when(r.window(F.col(cols[r.col])), F.struct(F.lit(j).alias("rank"), F.col(cols[r.col]).alias("value")))
            for j, r in enumerate(ranks)]
    rows = data.select(F.explode(F.array_compact(F.array(*held))).alias("h")).groupBy("h.rank", "h.value").count().collect()
    by_rank: dict[int, list] = {}
    for row in rows:
        by_rank.setdefault(row["rank"], []).append((row["value"], row["count"]))
    for j, r in enumerate(ranks):
        seen = r.below
        for value, n in sorted(by_rank.get(j, [])):
            seen += n
            if r.rank < seen:
                r.value = value
                break
        else:
            raise ArithmeticError("rank outside its bracket")


def columns_of(cols: list[str]) -> dict[str, Column]:
    return {c: F.col(f"`{c}`") for c in cols}
