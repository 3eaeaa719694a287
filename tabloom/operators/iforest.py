"""Isolation forest (Liu, Ting, Zhou 2008): trees on small samples, scores as one projection.

The method itself draws `SAMPLE` rows per tree, so trees are grown from TREES * SAMPLE rows at most,
one task per tree. Scoring runs over all rows with the trees, at most 511 nodes each, in the task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.profile import any_null, col
from tabloom.operators.quantiles import exact_quantiles
from tabloom.operators.state import StateModel
from tabloom.storage import settle

TREES, SAMPLE = 100, 256
NODES = "tree int, node int, feature int, cut double, left int, right int, length double"


def mean_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    many = np.where(n > 2, n, 3)
    long = 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, cut, left, right, length) of one random tree; leaves have feature -1."""
    nodes: list[list] = []
    open_nodes = [(0, np.arange(len(x)), 0)]
    nodes.append(None)
    while open_nodes:
        at, rows, depth = open_nodes.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        splits = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(splits):
            nodes[at] = (at, -1, 0.0, -1, -1, float(depth + mean_depth(len(rows))))
            continue
        f = int(rng.choice(splits))
        cut = float(rng.uniform(low[f], high[f]))
        goes_left = part[:, f] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (at, f, cut, left, right, 0.0)
        open_nodes += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def _samples(train: DataFrame, key: str, cols: list[str], seed: int) -> DataFrame:
    """(tree, x): SAMPLE different rows per tree. Rows are ranked by a seeded hash; tree t takes the
    SAMPLE ranks from t * SAMPLE on, going round when there are fewer rows."""
    ranked = train.select(
        F.xxhash64(col(key), F.lit(seed)).alias("h"), col(key).alias("k"),
        F.array(*[col(c).cast("double") for c in cols]).alias("x"),
    )
    pool = settle(ranked.orderBy("h", "k").limit(TREES * SAMPLE), "pool", TREES * SAMPLE)
    n = pool.count()
    if not n:
        raise ValueError("no rows to grow trees from")
    size = min(SAMPLE, n)
    ranked = F.row_number().over(Window.orderBy("h", "k")) - 1  # over the bounded pool only
    turns = F.explode(F.sequence(F.lit(0), F.lit((TREES * size - 1) // n)))
    slots = pool.withColumn("at", ranked).withColumn("turn", turns)
    tree = F.floor((F.col("at") + F.col("turn") * n) / size).cast("int")
    return slots.select(tree.alias("tree"), "x").where(F.col("tree") < TREES)


def fit(
    train: DataFrame, key: str, cols: list[str], contamination: float, seed: int
) -> "IsolationForestModel":
    present = train.where(~any_null(cols))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["tree"].iloc[0])
        x = np.vstack(pdf["x"].to_numpy())
        x = x[np.lexsort(x.T)]  # independent of arrival order
        rng = np.random.default_rng([seed, number])
        nodes = grow(x, rng, int(np.ceil(np.log2(max(len(x), 2)))))
        names = ["node", "feature", "cut", "left", "right", "length"]
        out = pd.DataFrame(nodes, columns=names)
        out.insert(0, "tree", number)
        return out

    samples = _samples(present, key, cols, seed)
    size = min(SAMPLE, present.count())
    nodes = settle(samples.groupBy("tree").applyInPandas(tree, NODES), "trees", TREES * 2 * SAMPLE)
    model = IsolationForestModel({"columns": cols, "size": size, "cut": None}, {"nodes": nodes})
    scored = present.select(model.score().alias("score"))
    cut = exact_quantiles(scored, {"score": F.col("score")}, [contamination])["score"][0]
    model.numbers["cut"] = cut
    return model


class IsolationForestModel(StateModel):
    """Keeps the rows whose score reaches the training cut; scores near -1 are outliers."""

    def score(self) -> Column:
        nodes = self.tables["nodes"].toPandas()  # at most TREES * 511 rows
        size, cols = self.numbers["size"], self.numbers["columns"]
        trees = []
        for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature, cut, left, right, length = (t[c].to_numpy() for c in ("feature", "cut", "left", "right", "length"))
            inner, own = feature >= 0, np.arange(len(feature))  # a leaf leads to itself
            next_node = np.stack([np.where(inner, right, own), np.where(inner, left, own)], 1).reshape(-1)
            trees.append((np.maximum(feature, 0), cut, next_node, length))
        depth = int(np.ceil(np.log2(max(size, 2))))
        norm = float(mean_depth(size)) or 1.0

        @F.pandas_udf("double")
        def scored(packed: pd.Series) -> pd.Series:
            held = packed.notna().to_numpy()
            out = np.full(len(packed), np.nan)
            if held.any():
                x = np.vstack(packed[held].to_numpy())
                total, flat, row = np.zeros(len(x)), x.reshape(-1), np.arange(len(x)) * x.shape[1]
                for feature, cut, next_node, length in trees:
                    at = np.zeros(len(x), dtype=int)
                    for _ in range(depth):
                        at = next_node.take(2 * at + (flat.take(row + feature.take(at)) <= cut.take(at)))
                    total += length.take(at)
                out[held] = -(2.0 ** (-total / len(trees) / norm))
            return pd.Series(out)

        packed = F.array(*[col(c).cast("double") for c in cols])
        return scored(F.when(~any_null(cols), packed))

    def _transform(self, df: DataFrame) -> DataFrame:
        """Rows with a missing model column cannot be scored and stay."""
        scored = df.withColumn("__score", self.score())
        kept = scored.where(F.col("__score").isNull() | F.isnan("__score") | (F.col("__score") >= self.numbers["cut"]))
        return kept.drop("__score")
