"""Random forests whose trees grow until their leaves are pure or a set limit is met.

Columns are cut into at most `bins` bins by training quantiles and the label is put on a fine integer
grid, so node sums are exact whole numbers and do not depend on where or in which order they are added.
A row's bootstrap weight and a node's candidate columns are functions of (seed, tree, row or node). So a
tree is the same wherever it grows:

- a training table of at most `local_rows` rows and `HELD_BYTES` is sent to the tasks once, one task per tree;
- of a larger one, nodes with more than `NODE_ROWS` rows are split by one scan per level for a group of trees: tasks
  sum histograms per (tree, node), one row per node and task is shuffled, and the best splits come back;
- a larger node that finds no gain or meets the depth limit is a leaf made of these sums, and its rows stay;
- a node with at most `NODE_ROWS` rows is finished inside one task;
- rows leave a scan for one group of `TREE_GROUP` trees at a time, and its subtrees are written before the next.

A row is told apart by its values and by its number among rows of equal values, so a forest does not
depend on how the table is cut into files and tasks. Bins are quantiles of about `BIN_ROWS` rows chosen by
that identity (all rows of a smaller table).

Grown trees are a table, one row per (tree, subtree). Up to `LOCAL_ROWS` rows and `HELD_BYTES` to predict are sent
to the tasks that read the trees; of more rows, chunks meet tree chunks by shuffle. So neither the forest nor a large
table has to fit one task or the driver. Leaf means are put on a grid on which their sums are exact in any order.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.profile import col
from tabloom.storage import materialize

LOCAL_ROWS = 10_000_000  # most rows that a task holds as a whole, if they fit `HELD_BYTES`
HELD_BYTES = 384 << 20
NODE_ROWS = 1_000_000  # most rows of a node that is finished inside one task, where the table is larger
TREE_GROUP = 16  # trees whose upper levels grow in the same scans
ROW_CHUNK, TREE_CHUNK = 500_000, 8
SUM_ROWS = 1 << 16  # predicted rows whose sums travel as one value
PASS_ROWS = 1 << 14  # rows that walk down a tree together
TASK_BYTES = 1 << 28  # trees that a task reads for prediction
GRID = (1 << 24) - 1
EXACT_BITS = 40  # bits of a leaf mean that are summed, counted from the top of the label grid
BIN_ROWS = 200_000  # rows that the bins are taken from
BATCH_ROWS = 32_768  # rows of small nodes that are split at once
TOGETHER = 10_000  # equal rows that are numbered in one piece


@dataclass(frozen=True)
class Growth:
    """Settings of a forest; `columns` is sqrt, log2, all or a share of the columns."""

    trees: int = 100
    depth: int = 0  # 0: no limit
    least_leaf: int = 1
    least_split: int = 2
    columns: str = "all"
    bootstrap: bool = True
    seed: int = 42
    bins: int = 128

    def per_node(self, p: int) -> int:
        n = {"sqrt": math.sqrt(p), "log2": math.log2(max(p, 2)), "all": p}.get(self.columns)
        return max(1, min(p, int(n if n is not None else float(self.columns) * p)))


@dataclass
class Tree:
    """Nodes in arrays: column (-1 for a leaf), the last bin that goes left, children, label means."""

    column: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def row_weights(rows: np.ndarray, tree: int, g: Growth) -> np.ndarray:
    """How often each row is drawn: Poisson(1) by the row's hash, or once each."""
    if not g.bootstrap:
        return np.ones(len(rows), np.int64)
    u = _mix(rows.astype(np.uint64) ^ _mix(np.full(1, (g.seed << 20) + tree, np.uint64))).astype(np.float64) / 2.0**64
    steps = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
    return np.searchsorted(steps, u, "right").astype(np.int64)


def _candidates(path: np.ndarray, tree: int, p: int, g: Growth) -> np.ndarray:
    """Columns a node may split on, by its path from the root: an array of nodes x columns."""
    k = g.per_node(p)
    if k == p:
        return np.tile(np.arange(p), (len(path), 1))
    keys = _mix(path[:, None] + _mix(np.arange(p, dtype=np.uint64) + np.uint64((g.seed << 24) + (tree << 8)))[None, :])
    if len(path) == 1:
        return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :k], axis=1)
    first = np.partition(keys, k - 1, axis=1)[:, k - 1:k]
    chosen = keys <= first
    if np.count_nonzero(chosen) > k * len(path):  # equal keys
        return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :k], axis=1)
    return (np.flatnonzero(chosen) % p).reshape(-1, k)


def _children(path: np.ndarray, right: bool) -> np.ndarray:
    return _mix(path * np.uint64(2) + np.uint64(1 + right))


ROOT = np.uint64(1)


def _classes_of(y: np.ndarray) -> np.ndarray:
    """The labels as one whole number per row: the grid value, or the number of the class that is 1."""
    return (y[:, 0] if y.shape[1] == 1 else y.argmax(1)).astype(np.int32)


def histograms(codes, label, w, columns: np.ndarray, bins: int, c: int) -> np.ndarray:
    """Sums of one node per (candidate, bin): rows, weight, and weighted label of every class."""
    out = np.zeros((1, len(columns), bins, 2 + c), np.float64)
    plain = w.min(initial=1) == w.max(initial=1) == 1
    weighted = None if c > 1 and plain else w.astype(np.float64) if c > 1 else label * w.astype(np.float64)
    for j, column in enumerate(columns):
        cell = codes[:, column].astype(np.intp)
        out[0, j, :, 0] = np.bincount(cell, minlength=bins)
        out[0, j, :, 1] = out[0, j, :, 0] if plain else np.bincount(cell, w, bins)
        if c > 1:
            out[0, j, :, 2:] = np.bincount(cell * c + label, weighted, bins * c).reshape(bins, c)
        else:
            out[0, j, :, 2] = np.bincount(cell, weighted, bins)
    return out


def best_splits(h: np.ndarray, g: Growth) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node: candidate number, last bin on the left, and the decrease of the squared error; the
    decrease is 0 where no split is allowed or helps."""
    m, k, bins, _ = h.shape
    left = h.cumsum(2)
    total = left[:, :, -1:, :]
    right = total - left
    ok = (left[..., 0] >= max(g.least_leaf, 1)) & (right[..., 0] >= max(g.least_leaf, 1))

    def between(s: np.ndarray) -> np.ndarray:
        return (s[..., 2:] ** 2).sum(-1) / np.maximum(s[..., 1], 1)

    gain = np.where(ok, between(left) + between(right) - between(total), 0.0).reshape(m, -1)
    best = gain.argmax(1)
    return best // bins, best % bins, gain[np.arange(m), best]


def _words(label, w, c: int) -> list[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Weight and weighted labels of the rows, side by side in as few whole numbers as hold their sums:
    (numbers, [(shift, mask) of each part]). Parts in order: weight, then one per class."""
    w = w.astype(np.int64)
    parts = [w, w * label] if c == 1 else [w, *[np.where(label == i, w, 0) for i in range(c)]]
    words, room = [], 0
    for part in parts:
        bits = max(int(part.sum()).bit_length(), 1)
        if bits > room:
            words.append([np.zeros(len(w), np.int64), []])
            room = 63
        shift = 63 - room
        words[-1][0] += part << shift
        words[-1][1].append((shift, (1 << bits) - 1))
        room -= bits
    return [(a, at) for a, at in words]


def _parts_of(sums: list[np.ndarray], words) -> list[np.ndarray]:
    """Weight and weighted labels out of sums of words."""
    return [((s >> shift) & mask).astype(np.float64) for s, (_, at) in zip(sums, words) for shift, mask in at]


def sorted_splits(code, rows: np.ndarray, words, sums: list[np.ndarray], g: Growth):
    """The splits that `best_splits` finds, for many small nodes at once: from the bins of the rows, candidates x
    rows in the order of the nodes, sorted by (node, bin). Sums are whole numbers, so both ways agree to the bit.
    Also the number of rows on the left and the rows of each node in the order of its chosen column."""
    k, n = code.shape
    m = len(rows)
    bits, bin_bits = max(n - 1, 1).bit_length(), (g.bins - 1).bit_length()  # a key carries its row below it, so plain numbers are sorted
    kind = np.uint32 if bits + bin_bits + m.bit_length() <= 32 else np.uint64
    start = np.cumsum(rows) - rows
    at = np.repeat(np.arange(m, dtype=kind), rows)
    key = code.astype(kind)
    key <<= kind(bits)
    key += (at << kind(bits + bin_bits)) + np.arange(n, dtype=kind)
    key.sort(axis=1)
    order = (key & kind((1 << bits) - 1)).reshape(-1)
    key >>= kind(bits)
    ends = np.ones((k, n), bool)
    np.not_equal(key[:, 1:], key[:, :-1], out=ends[:, :-1])
    last = np.flatnonzero(ends)
    node_ends = (np.arange(k)[:, None] * n + (start + rows - 1)).reshape(-1)
    upto = np.searchsorted(last, node_ends) + 1  # cells of the nodes up to each (candidate, node)
    first = np.concatenate([[0], upto[:-1]])
    counts = upto - first
    spread = np.repeat(np.tile(np.arange(m), k), counts)
    left = []
    for (word, _), s in zip(words, sums):
        running = word.take(order).reshape(k, n).cumsum(axis=1).reshape(-1).take(last)
        left.append(running - (np.cumsum(s) - s).take(spread))
    w_left, *s_left = _parts_of(left, words)
    weight, *total = _parts_of(sums, words)
    whole = (sum(t ** 2 for t in total) / np.maximum(weight, 1)).take(spread)
    w_right = weight.take(spread) - w_left
    value = sum(a ** 2 for a in s_left) / np.maximum(w_left, 1) \
        + sum((t.take(spread) - a) ** 2 for t, a in zip(total, s_left)) / np.maximum(w_right, 1) - whole
    if g.least_leaf > 1:
        n_left = last % n + 1 - start.take(spread)
        value[(n_left < g.least_leaf) | (rows.take(spread) - n_left < g.least_leaf)] = 0.0
    else:
        value[w_right < 1] = 0.0
    top = np.maximum.reduceat(value, first)
    pick = top.reshape(k, m).argmax(0)
    chosen = pick * m + np.arange(m)
    hit = np.flatnonzero(value == np.repeat(top, counts))
    where = hit[np.searchsorted(hit, first[chosen])]  # the lowest bin that reaches it
    cut = (key.reshape(-1).take(last[where]) & kind((1 << bin_bits) - 1)).astype(np.int64)
    return pick, cut, np.maximum(top[chosen], 0.0), last[where] + 1 - pick * n - start, order


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: np.uint64, depth: int, g: Growth) -> tuple[Tree, np.ndarray]:
    """A subtree from the rows of its root, and its decrease of error per column. A node of more than
    `BATCH_ROWS` rows is split from histograms; smaller ones wait on a stack and are split many at a time, as
    many as have that number of rows, so that the work of a batch stays in the cache. The two children of a node
    are numbered one after the other."""
    p, c = codes.shape[1], y.shape[1]
    gains = np.zeros(p)
    keep = w > 0
    if not keep.all():
        codes, y, w = codes[keep], y[keep], w[keep]
    if not len(codes):
        return Tree([-1], [0], [0], [0], [[0.0] * c]), gains
    if not np.isfinite(y).all():
        return Tree([-1], [0], [0], [0], [[math.nan] * c]), gains
    # pieces: rows in the order of their nodes (bins, label, weight), and the nodes (rows, path, number, level)
    stack = [(codes, _classes_of(y), w, np.array([len(codes)]), np.array([path], np.uint64), np.array([0]), np.array([depth]))]
    del codes, y, w, keep
    made, found = 1, []
    while stack:
        taken = [stack.pop()]
        size = len(taken[0][0])
        while stack and size + len(stack[-1][0]) <= BATCH_ROWS:
            taken.append(stack.pop())
            size += len(taken[-1][0])
        codes, label, w, rows, paths, ids, depths = taken[0] if len(taken) == 1 else map(np.concatenate, zip(*taken))
        del taken
        start = np.cumsum(rows) - rows
        words = _words(label, w, c)
        sums = [np.add.reduceat(word, start) for word, _ in words]
        weight, *total = _parts_of(sums, words)
        m = len(rows)
        column, cut, left = np.full(m, -1), np.zeros(m, np.int64), np.zeros(m, np.int64)
        found.append((ids, column, cut, left, np.stack(total, 1) / np.maximum(weight, 1)[:, None]))
        may = (rows >= max(g.least_split, 2)) & np.logical_or.reduceat(label != np.repeat(label[start], rows), start)
        if g.depth:
            may &= depths < g.depth
        open_ = np.flatnonzero(may)
        if not len(open_):
            continue
        columns = _candidates(paths[open_], tree, p, g)
        if size > BATCH_ROWS:  # one node
            pick, at, gain = best_splits(histograms(codes, label, w, columns[0], g.bins, c), g)
            right = codes[:, columns[0, pick[0]]] > at[0]
            order = np.concatenate([np.flatnonzero(~right), np.flatnonzero(right)])
            n_left = np.array([size - np.count_nonzero(right)])
            split = np.flatnonzero(gain > 1e-9)
        else:
            here = np.arange(size)
            if len(open_) < m:
                here = np.flatnonzero(np.repeat(may, rows))
                words = [(word.take(here), at) for word, at in words]
                sums = [s.take(open_) for s in sums]
            inside = rows.take(open_)
            code = codes.reshape(-1).take(here * p + np.repeat(columns.T, inside, axis=1))
            pick, at, gain, n_left, order = sorted_splits(code, inside, words, sums, g)
            split = np.flatnonzero(gain > 1e-9)
            # the rows of a split node in the order of its column: left ones first
            begin, many = (np.cumsum(inside) - inside + pick * len(here)).take(split), inside.take(split)
            order = here.take(order.take(np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())))
        if not len(split):
            continue
        gone = open_[split]
        column[gone], cut[gone], left[gone] = columns[split, pick[split]], at[split], made + 2 * np.arange(len(split))
        gains += np.bincount(column[gone], gain[split], p)
        ids = made + np.arange(2 * len(split))
        made += len(ids)
        n_left, rows, paths, depths = n_left[split], rows[gone], paths[gone], np.repeat(depths[gone] + 1, 2)
        rows = np.stack([n_left, rows - n_left], 1).reshape(-1)
        paths = np.stack([_children(paths, False), _children(paths, True)], 1).reshape(-1)
        codes, label, w = codes.take(order, 0), label.take(order), w.take(order)
        if size > BATCH_ROWS:
            a = int(rows[0])
            stack.append((codes[a:], label[a:], w[a:], rows[1:], paths[1:], ids[1:], depths[1:]))
            stack.append((codes[:a], label[:a], w[:a], rows[:1], paths[:1], ids[:1], depths[:1]))
        else:
            stack.append((codes, label, w, rows, paths, ids, depths))
    place, *kept = map(np.concatenate, zip(*found))
    order = np.empty(made, np.int64)
    order[place] = np.arange(made)
    column, cut, left, value = (a.take(order, 0) for a in kept)
    return Tree(column, cut, left, np.where(column >= 0, left + 1, 0), value), gains


def _packed(t: Tree) -> dict:
    return {"column": np.array(t.column, np.int16).tobytes(), "cut": np.array(t.cut, np.int16).tobytes(),
            "left": np.array(t.left, np.int32).tobytes(), "right": np.array(t.right, np.int32).tobytes(),
            "value": np.array(t.value, np.float64).tobytes()}


def _stored(t: Tree) -> dict:
    """The nodes of a tree in few bytes: column of every node (the last number for a leaf), cut and left child of the
    inner ones (the right child is the next), label means of the leaves."""
    column, inner = np.array(t.column, np.int64), np.array(t.column, np.int64) >= 0
    kind = np.uint8 if column.max() < 255 else np.uint16
    nodes = [np.where(inner, column, np.iinfo(kind).max).astype(kind), np.array(t.cut)[inner].astype(np.uint8), np.array(t.left)[inner].astype(np.int32)]
    return {"nodes": b"".join([kind().itemsize.to_bytes(1), len(column).to_bytes(8, "little"), *[x.tobytes() for x in nodes]]),
            "value": np.array(t.value, np.float64)[~inner].tobytes()}


def _walkable(nodes: bytes) -> np.ndarray:
    """One number per node: left child, column and cut; of a leaf its place among the leaves, below zero."""
    kind, n = (np.uint8, np.uint16)[nodes[0] - 1], int.from_bytes(nodes[1:9], "little")
    column = np.frombuffer(nodes, kind, n, 9)
    inner = np.flatnonzero(column != np.iinfo(kind).max)
    cut = np.frombuffer(nodes, np.uint8, len(inner), 9 + n * kind().itemsize)
    left = np.frombuffer(nodes, np.int32, len(inner), 9 + n * kind().itemsize + len(inner))
    out = np.empty(n, np.int64)
    leaf = np.ones(n, bool)
    leaf[inner] = False
    out[leaf] = ~np.arange(n - len(inner))
    out[inner] = (left.astype(np.int64) << 24) | (column[inner].astype(np.int64) << 8) | cut
    return out


PART = "tree int, path long, nodes binary, value binary, gains binary, size long"


def _part(tree: int, path, t: Tree, gains: np.ndarray) -> pa.RecordBatch:
    row = {"tree": tree, "path": int(np.array(path, np.uint64).astype(np.int64)), **_stored(t), "gains": gains.tobytes()}
    row["size"] = len(row["nodes"]) + len(row["value"])
    kinds = {"tree": pa.int32(), "path": pa.int64(), "size": pa.int64()}
    return pa.RecordBatch.from_pydict({k: pa.array([v], kinds.get(k, pa.binary())) for k, v in row.items()})


@dataclass
class Forest:
    """`parts` holds every subtree; `top` the upper nodes per tree: {path: (column, cut)}."""

    parts: DataFrame
    top: dict
    columns: list[str]
    cuts: list[np.ndarray]
    growth: Growth
    low: np.ndarray
    step: np.ndarray
    classes: list | None
    gains: np.ndarray
    size: int  # bytes of the subtrees

    def importances(self) -> np.ndarray:
        """Decrease of error per column: shares within each tree, averaged over the trees."""
        total = self.gains.sum(1, keepdims=True)
        share = np.divide(self.gains, total, out=np.zeros_like(self.gains), where=total > 0)
        mean = share.mean(0)
        return mean / mean.sum() if mean.sum() > 0 else mean

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return _predict(self, df, out)


def _codes_of(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1).astype(np.uint8)


def _rows_of_bytes(codes: np.ndarray) -> pa.Array:
    cells = pa.py_buffer(np.ascontiguousarray(codes))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(codes.shape[1]), len(codes), [None, cells]).cast(pa.binary())


def _bytes_of_rows(column: pa.Array | pa.ChunkedArray, p: int) -> np.ndarray:
    """The bins of the rows as a matrix, without one Python object per row."""
    parts = [np.empty(0, np.uint8)]
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(c):
            wide = np.int64 if pa.types.is_large_binary(c.type) else np.int32
            ends = np.frombuffer(c.buffers()[1], wide)[c.offset:c.offset + len(c) + 1]
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    return (parts[1] if len(parts) == 2 else np.concatenate(parts)).reshape(-1, p)


def _binned(df: DataFrame, cols: list[str], cuts: list[np.ndarray], keep: list[str]) -> DataFrame:
    """`keep` columns and the bins of each row; a missing value is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            if any(b.column(len(keep) + j).null_count for j in range(len(cols))):
                raise ValueError("a model column has missing values")
            x = np.stack([b.column(len(keep) + j).to_numpy() for j in range(len(cols))], 1)
            codes = _codes_of(x, cuts)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))],
                                              _rows_of_bytes(codes)], names=[*keep, "codes"])

    chosen = df.select(*keep, *[col(c).cast("double").alias(f"__x{j}") for j, c in enumerate(cols)])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    return chosen.mapInArrow(run, f"{schema}, codes binary")


def _quantile_cuts(df: DataFrame, cols: list[str], bins: int) -> list[np.ndarray]:
    p = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile(col(c), p).alias(f"q{j}") for j, c in enumerate(cols)]).first()
    return [np.unique(np.array(v, float)) if v is not None else np.empty(0) for v in row]


def _numbered(rows: DataFrame, cols: list[str], label: str, kind: str) -> DataFrame:
    """Columns as doubles, `__label`, and `__h`: a hash of the row's values and of its number among equal rows.
    Equal rows are counted before the shuffle, and a large count is numbered by several tasks."""
    values = rows.select(*[col(c).cast("double") for c in cols], col(label).cast(kind).alias("__label"))
    counted = values.groupBy(*[col(c) for c in values.columns]).agg(F.count(F.lit(1)).alias("__n"))
    step = F.lit(TOGETHER).cast("long")
    pieces = counted.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, step)))
    hashed = F.xxhash64(*[col(c) for c in values.columns])
    pieces = pieces.withColumn("__h", hashed).repartition("__h", "__from")
    each = pieces.withColumn("__at", F.explode(F.sequence("__from", F.least(F.col("__from") + step, F.col("__n")) - 1)))
    return each.withColumn("__h", F.xxhash64("__h", "__at")).drop("__n", "__from", "__at")


def fit(df: DataFrame, cols: list[str], label: str, g: Growth = Growth(), classes: bool = False,
        local_rows: int = LOCAL_ROWS) -> Forest:
    """Grow a forest on the rows that have a label; with `classes`, on one indicator per class."""
    rows = materialize(_numbered(df.where(col(label).isNotNull()), cols, label, "string" if classes else "double"), "rows")
    n = rows.count()
    if n == 0:
        raise ValueError("no row has a label")
    cuts = _quantile_cuts(rows.where(F.pmod("__h", F.lit(n)) < BIN_ROWS), cols, g.bins)
    names = None
    if classes:
        names = sorted(r[0] for r in rows.select("__label").distinct().collect())
        y = F.array(*[(F.col("__label") == c).cast("double") for c in names])
        low, step = np.zeros(len(names)), np.ones(len(names))
    else:
        ends = rows.agg(F.min("__label"), F.max("__label")).first()
        low, step = np.array([ends[0]]), np.array([(ends[1] - ends[0]) / GRID or 1.0])
        y = F.array(F.round((F.col("__label") - float(low[0])) / float(step[0])))
    data = materialize(_binned(rows.select(*[col(c) for c in cols], y.alias("__y"), "__h"), cols, cuts, ["__h", "__y"]), "binned")
    if n <= local_rows and n * (len(cols) + 8 + 8 * len(low)) <= HELD_BYTES:
        parts, top = _grow_everywhere(data, g, len(cols), n), {}
        gains_of_top = np.zeros((g.trees, len(cols)))
    else:
        parts, top, gains_of_top = _grow_from_the_top(data, g, len(cols), min(local_rows, NODE_ROWS))
    parts = materialize(parts, "trees")
    gains, size = gains_of_top, 0
    for r in parts.select("tree", "gains", "size").collect():  # one row per subtree
        gains[r["tree"]] += np.frombuffer(r["gains"], np.float64)
        size += r["size"]
    return Forest(parts, top, cols, cuts, g, low, step, names, gains, size)


def _arrays(rows: pa.Table | pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = rows.column("__h").to_numpy()
    y = rows.column("__y")
    y = np.concatenate([c.flatten().to_numpy() for c in (y.chunks if isinstance(y, pa.ChunkedArray) else [y])])
    return h, y.reshape(len(h), -1), _bytes_of_rows(rows.column("codes"), p)


def _grow_everywhere(data: DataFrame, g: Growth, p: int, n: int) -> DataFrame:
    """The table is small: every task gets it once and grows whole trees, one at a time where they are large."""
    spark = data.sparkSession
    held = spark.sparkContext.broadcast(_arrays(data.toArrow(), p))  # at most `local_rows` rows and `HELD_BYTES`

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, y, codes = held.value
        for b in batches:
            for tree in b.column(0).to_pylist():
                t, gains = grow(codes, y, row_weights(h, tree, g), tree, ROOT, 0, g)
                yield _part(tree, ROOT, t, gains)

    tasks = max(4 * spark.sparkContext.defaultParallelism, n * g.trees // 2_000_000)
    each = spark.range(0, g.trees, 1, min(g.trees, tasks))
    return each.mapInArrow(run, PART)


def _walk(top: dict, codes: np.ndarray, tree: int) -> np.ndarray:
    """Path of the node that each row has reached below the upper nodes of a tree."""
    path = np.full(len(codes), ROOT, np.uint64)
    nodes = top.get(tree, {})
    todo = [(ROOT, np.arange(len(codes)))] if nodes else []
    while todo:
        at, rows = todo.pop()
        split = nodes.get(int(at))
        if split is None:
            path[rows] = at
            continue
        right = codes[rows, split[0]] > split[1]
        here = np.array([at], np.uint64)
        todo += [(_children(here, False)[0], rows[~right]), (_children(here, True)[0], rows[right])]
    return path


def _grow_from_the_top(data: DataFrame, g: Growth, p: int, local_rows: int):
    """Upper levels by scans, a group of trees at a time; then every open node in one task."""
    top: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in range(g.trees)}
    closed: dict[int, dict[int, list[float]]] = {t: {} for t in range(g.trees)}  # large leaves: {path: label means}
    gains = np.zeros((g.trees, p))
    finished = []
    for first in range(0, g.trees, TREE_GROUP):
        group = range(first, min(first + TREE_GROUP, g.trees))
        large = {t: {int(ROOT): []} for t in group}
        depth = 0
        while any(large.values()) and not (g.depth and depth >= g.depth):
            found = _level(data, {t: top[t] for t in large}, large, g, p).collect()  # one row per open node
            large = {t: {} for t in large}
            for r in found:
                t, path = r["tree"], np.array([r["path"]], np.int64).astype(np.uint64)
                if r["gain"] <= 1e-9:
                    closed[t][int(path[0])] = r["mean"]
                    continue
                top[t][int(path[0])] = (r["column"], r["cut"])
                gains[t, r["column"]] += r["gain"]
                for side, n, mean in ((False, r["n_left"], r["mean_left"]), (True, r["n_right"], r["mean_right"])):
                    if n > local_rows:
                        large[t][int(_children(path, side)[0])] = mean
            depth += 1
        for t, nodes in large.items():  # those at the depth limit
            closed[t].update(nodes)
        finish = _finish(data, {t: top[t] for t in group}, {t: closed[t] for t in group}, g, p)
        finished.append(materialize(finish, "subtrees"))
    return functools.reduce(DataFrame.union, finished), top, gains


def _level(data: DataFrame, top: dict, large: dict, g: Growth, p: int) -> DataFrame:
    """Best split of every large node: histograms per task, summed by (tree, node)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            h, y, codes = _arrays(b, p)
            c = y.shape[1]
            label = y[:, 0] if c == 1 else _classes_of(y)
            for tree, open_nodes in large.items():
                w = row_weights(h, tree, g)
                path = _walk(top, codes, tree)
                for node in open_nodes:
                    use = (path == np.uint64(node)) & (w > 0)
                    if use.any():
                        columns = _candidates(np.array([node], np.uint64), tree, p, g)
                        part = histograms(codes[use], label[use], w[use], columns[0], g.bins, c)[0]
                        sums[tree, node] = sums.get((tree, node), 0) + part
        for (tree, node), v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([np.uint64(node).astype(np.int64)]), pa.array([v.tobytes()], pa.binary())],
                                             names=["tree", "path", "sums"])

    def choose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, path = key[0].as_py(), np.array([key[1].as_py()], np.int64).astype(np.uint64)
        columns = _candidates(path, tree, p, g)
        parts = [np.frombuffer(v, np.float64) for v in table.column("sums").to_pylist()]
        h = np.sum(parts, axis=0).reshape(1, columns.shape[1], g.bins, -1)
        pick, cut, gain = best_splits(h, g)
        gain = np.nan_to_num(gain)  # labels that are no numbers
        left = h[0, pick[0], :cut[0] + 1, 0].sum()
        n = h[0, pick[0], :, 0].sum()
        if n < max(g.least_split, 2):
            gain[:] = 0
        upto = h[0, pick[0], :cut[0] + 1, 1:].sum(0)
        total = h[0, pick[0], :, 1:].sum(0)
        means = {k: pa.array([(v[1:] / max(v[0], 1)).tolist()], pa.list_(pa.float64()))
                 for k, v in (("mean", total), ("mean_left", upto), ("mean_right", total - upto))}
        return pa.table({"tree": pa.array([tree], pa.int32()), "path": pa.array([key[1].as_py()], pa.int64()), "column": pa.array([int(columns[0, pick[0]])], pa.int32()),
                         "cut": pa.array([int(cut[0])], pa.int32()), "gain": [float(gain[0])], "n_left": pa.array([int(left)], pa.int64()), "n_right": pa.array([int(n - left)], pa.int64()), **means})

    return data.mapInArrow(partial, "tree int, path long, sums binary").groupBy("tree", "path") \
        .applyInArrow(choose, "tree int, path long, column int, cut int, gain double, n_left long, n_right long, "
                      "mean array<double>, mean_left array<double>, mean_right array<double>")


def _depth_of(top: dict, path: int) -> int:
    """Levels from the root to an open node, by walking the upper nodes."""
    level, depth = [int(ROOT)], 0
    while path not in level:
        below = [np.array([x], np.uint64) for x in level if x in top]
        level = [int(_children(x, s)[0]) for x in below for s in (False, True)]
        depth += 1
        if not level:
            raise KeyError(path)
    return depth


def _finish(data: DataFrame, top: dict, closed: dict, g: Growth, p: int) -> DataFrame:
    """Subtrees of the open nodes of the trees in `top`, each in one task, and the large leaves."""
    done = {t: np.array(list(nodes), np.uint64).astype(np.int64) for t, nodes in closed.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            h, _, codes = _arrays(b, p)
            for tree in top:
                at = np.flatnonzero(row_weights(h, tree, g) > 0)
                path = _walk(top, codes[at], tree).astype(np.int64)
                open_ = ~np.isin(path, done[tree])
                at, path = at[open_], path[open_]
                rows = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree, np.int32)), pa.array(path), *rows.columns],
                                                 names=["tree", "path", "__h", "__y", "codes"])

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, path = key[0].as_py(), np.array([key[1].as_py()], np.int64).astype(np.uint64)[0]
        h, y, codes = _arrays(table, p)
        t, gains = grow(codes, y, row_weights(h, tree, g), tree, path, _depth_of(top[tree], int(path)), g)
        return pa.Table.from_batches([_part(tree, path, t, gains)])

    routed = data.select("__h", "__y", "codes").mapInArrow(route, "tree int, path long, __h long, __y array<double>, codes binary")
    leaves = [_part(t, path, Tree([-1], [0], [0], [0], [mean]), np.zeros(p)) for t, nodes in closed.items() for path, mean in nodes.items()]
    finished = routed.groupBy("tree", "path").applyInArrow(finish, PART)
    if not leaves:
        return finished
    return finished.union(data.sparkSession.createDataFrame(pa.Table.from_batches(leaves), PART))


def _predict(forest: Forest, df: DataFrame, out: str) -> DataFrame:
    """Mean of the trees (for classes the class with the largest mean), joined to the rows."""
    g, p, c = forest.growth, len(forest.columns), len(forest.low)
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "to-predict")  # numbers are read back
    codes = _binned(rows, forest.columns, forest.cuts, ["__row"])
    n = rows.count()
    scale = 2.0 ** (EXACT_BITS if forest.classes is not None else EXACT_BITS - GRID.bit_length())

    def values_of(part: dict, x: np.ndarray) -> np.ndarray:
        return _leaf_values(part, x, c, lambda v: np.round(v * scale) / scale)

    if n <= LOCAL_ROWS and n * (p + 8 + 8 * c) <= HELD_BYTES:
        mean = _sums_beside_the_trees(forest, codes, values_of, p, c)
    else:
        summed = _sums_by_chunks(forest, codes, n, values_of, p, c)
        mean = summed.groupBy("__row").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(c)])
    values = [F.col(f"s{i}") / F.lit(g.trees) * F.lit(float(forest.step[i])) + F.lit(float(forest.low[i])) for i in range(c)]
    if forest.classes is None:
        best = values[0]
    else:
        scores = F.array(*values)
        best = F.element_at(F.array(*[F.lit(x) for x in forest.classes]), F.array_position(scores, F.array_max(scores)).cast("int"))
    scored = mean.select("__row", best.alias(out))
    return rows.join(scored, "__row").select(*[col(x) for x in df.columns if x != out], F.col(out))


def _add_part(total: np.ndarray, part: dict, top: dict, x: np.ndarray, values_of) -> None:
    """Add a subtree's leaf means to the sums of the rows that reach it."""
    if not top.get(part["tree"]):
        total += values_of(part, x)
        return
    use = np.flatnonzero(_walk(top, x, part["tree"]).astype(np.int64) == part["path"])
    if len(use):
        total[use] += values_of(part, x[use])


def _sums_beside_the_trees(forest: Forest, codes: DataFrame, values_of, p: int, c: int) -> DataFrame:
    """(__row, s0..) of at most `LOCAL_ROWS` rows: every task gets them once and reads its share of the trees. The
    sums of `SUM_ROWS` rows leave a task as one value."""
    spark, top = codes.sparkSession, forest.top
    table = codes.toArrow()
    held = spark.sparkContext.broadcast((table.column("__row").to_numpy(), _bytes_of_rows(table.column("codes"), p)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = held.value[1]
        total, any_part = np.zeros((len(x), c)), False
        for b in batches:
            for i in range(b.num_rows):
                _add_part(total, {k: b.column(k)[i].as_py() for k in b.schema.names}, top, x, values_of)
                any_part = True
        for a in range(0, len(x) if any_part else 0, SUM_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([total[a:a + SUM_ROWS].tobytes()], pa.binary())], names=["first", "sums"])

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = held.value[0][key[0].as_py():][:SUM_ROWS]
        total = np.zeros((len(rows), c))
        for v in table.column("sums"):
            total += np.frombuffer(v.as_buffer(), np.float64).reshape(-1, c)
        return pa.table([pa.array(rows), *[pa.array(total[:, i]) for i in range(c)]], names=["__row", *[f"s{i}" for i in range(c)]])

    tasks = max(2 * spark.sparkContext.defaultParallelism, -(-forest.size // TASK_BYTES))
    summed = forest.parts.drop("gains", "size").coalesce(tasks).mapInArrow(run, "first long, sums binary")
    return summed.groupBy("first").applyInArrow(add, "__row long, " + ", ".join(f"s{i} double" for i in range(c)))


def _sums_by_chunks(forest: Forest, codes: DataFrame, n: int, values_of, p: int, c: int) -> DataFrame:
    """(__row, sums): chunks of rows meet chunks of trees."""
    chunks, groups = max(1, -(-n // ROW_CHUNK)), -(-forest.growth.trees // TREE_CHUNK)
    top = forest.top
    left = codes.withColumn("chunk", F.pmod(F.xxhash64("__row"), F.lit(chunks))) \
        .withColumn("trees", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = forest.parts.drop("gains", "size").withColumn("trees", F.floor(F.col("tree") / TREE_CHUNK).cast("int")) \
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"__row": pa.array([], pa.int64()), "sums": pa.array([], pa.list_(pa.float64()))})
        x = _bytes_of_rows(left.column("codes"), p)
        total = np.zeros((len(x), c))
        by_tree: dict[int, list] = {}
        for r in right.to_pylist():
            by_tree.setdefault(r["tree"], []).append(r)
        for tree, parts in by_tree.items():
            path = _walk(top, x, tree).astype(np.int64)
            for r in parts:
                use = np.flatnonzero(path == r["path"])
                if len(use):
                    total[use] += values_of(r, x[use])
        return pa.table({"__row": left.column("__row"), "sums": pa.array(list(total), pa.list_(pa.float64()))})

    return left.groupBy("chunk", "trees").cogroup(right.groupBy("chunk", "trees")) \
        .applyInArrow(apply, "__row long, sums array<double>")


def _leaf_values(part: dict, x: np.ndarray, c: int, change=lambda v: v) -> np.ndarray:
    """Label means, changed by `change`, of the leaves that the rows reach."""
    nodes, p, flat = _walkable(part["nodes"]), x.shape[1], np.ascontiguousarray(x).reshape(-1)
    value = change(np.frombuffer(part["value"], np.float64).reshape(-1, c))
    if len(nodes) == 1:
        return np.repeat(value, len(x), axis=0)
    leaf = np.empty(len(x), np.int64)
    for a in range(0, len(x), PASS_ROWS):
        todo = np.arange(a, min(a + PASS_ROWS, len(x)))
        cell, node = todo * p, np.full(len(todo), nodes[0])
        while len(todo):
            step = (node >> 24) + (flat.take(cell + ((node >> 8) & 0xFFFF)) > (node & 0xFF))
            node = nodes.take(step)
            inner = node >= 0
            if not inner.all():
                done = ~inner
                leaf[todo[done]] = ~node[done]
                todo, cell, node = todo[inner], cell[inner], node[inner]
    return value.take(leaf, 0)


def frame_of(parts: DataFrame) -> pd.DataFrame:
    """The grown subtrees in a fixed order, for comparisons of small forests."""
    return parts.toPandas().sort_values(["tree", "path"]).reset_index(drop=True)
