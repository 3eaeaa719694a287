"""Exact k nearest neighbours by a hierarchy of bounding boxes, and the imputer built on it.

Donors of a group are sorted by which columns they have and along a space-filling curve, then cut
into blocks of at most `DONOR_ROWS` rows; receivers likewise, into larger blocks. A block carries its
bounding box and the columns that all and that any of its rows have. `FAN` blocks in a row are a node of
the next level, and so on up to a level of at most `TOP_NODES` nodes. A search

1. walks every receiver block down to one near node and measures its rows there, which bounds the k-th
   distance of every row from above;
2. walks down again, from level to level, and drops every node that is further away than the largest bound;
3. lets the receiver block meet the donor blocks that are left. A task sorts the donors of its tile into a tree of
   small boxes: the nearest boxes of a receiver bound its k-th distance, then it meets the boxes within that bound,
   and donors that a matrix product tells cannot be among the k best are left out before exact distances are taken.

Blocks that meet are dealt to tasks as tiles, some receiver blocks in a row by some donor blocks, so a
block travels once per tile and not once per pair.

No group is collected, no pair of rows is emitted, and no candidate that could win is skipped: at most k
donors per receiver leave a task, by distance and then lowest id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tabloom.operators.profile import any_null, col
from tabloom.operators.scale import group_statistics, scale_in_group, scale_statistics
from tabloom.operators.state import StateModel, replace
from tabloom.storage import materialize

DONOR_ROWS = 256  # powers of two: a block number is a shifted row number
RECEIVER_ROWS = 2048
FAN = 4  # bits of a block number that a level takes off: a node has up to 16 children
TOP_NODES = 64
SHARE = 2048  # most donor blocks of a tile, which its task holds
TILES = 512  # a measure of how finely a search is cut into tiles
TILE_BITS = 7  # bits of a receiver block number that a tile takes off, at most
TOGETHER_ROWS = 16_384  # receivers that search together
LEAF_ROWS, BRANCH = 256, 8
SEEDS = 4  # leaves that bound a row's k-th distance
BESIDE_ROWS = 2048  # receivers whose boxes are compared at once
PAIRS = 2_000_000  # pairs held at once
FAR = 1e290  # stands for no limit where products are taken
CURVE_BITS = 60
PATTERN_BITS = 63  # columns whose presence is told by a pattern; further ones are taken as unknown
SLACK = 1 + 1e-9  # bounds come from another engine's arithmetic

ANY = -1  # target of a plain search: every donor qualifies


def _xs(p: int) -> list[str]:
    return [f"x{j}" for j in range(p)]


def whole_key(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """The frame and a column of whole numbers that names its rows: the key itself, or for a key of another
    type a new column __key, in the order of the keys."""
    if isinstance(df.select(col(key)).schema[0].dataType, IntegralType):
        return df, key
    names = df.select(col(key).alias("__name")).distinct().repartitionByRange("__name").sortWithinPartitions("__name")
    names = materialize(names.withColumn("__key", F.monotonically_increasing_id()), "keys")
    return df.join(names, col(key).eqNullSafe(F.col("__name"))).drop("__name"), "__key"


def _points(df: DataFrame, key: str, group: str | None, cols: list[str]) -> DataFrame:
    """(id, g, x0.., pattern): pattern has bit j set when x_j is present, for the first `PATTERN_BITS`."""
    xs = _xs(len(cols))
    named = df.select(
        col(key).cast("bigint").alias("id"),
        (F.lit("") if group is None else col(group).cast("string")).alias("g"),
        *[col(c).cast("double").alias(x) for c, x in zip(cols, xs)],
    )
    bits = " + ".join(f"if({x} is null, 0L, {1 << j}L)" for j, x in enumerate(xs[:PATTERN_BITS]))
    return named.selectExpr("*", f"{bits} as pattern")


def _ranges(points: DataFrame, p: int) -> list[list[float]]:
    row = points.agg(*[F.percentile_approx(x, [0.01, 0.99], 200).alias(x) for x in _xs(p)]).first()
    return [list(row[x]) if row[x] is not None else [0.0, 0.0] for x in _xs(p)]


def _with_curve(points: DataFrame, ranges: list[list[float]]) -> DataFrame:
    """Add `z`, the position along a Z-order curve that halves the longest side of its cells each time, so
    cells are about as long in every column; it only decides which rows share a block."""
    used = [(j, low, high) for j, (low, high) in enumerate(ranges) if high > low][:CURVE_BITS]
    if not used:
        return points.selectExpr("*", "0L as z")
    sides = [high - low for _, low, high in used]
    bits, turns = [0] * len(used), []
    for _ in range(CURVE_BITS):
        at = max(range(len(used)), key=lambda i: (sides[i], -i))
        turns.append((at, bits[at]))
        sides[at], bits[at] = sides[at] / 2, bits[at] + 1
    levels = [
        f"cast(coalesce(least(greatest(floor((x{j} - {low!r}d) * {float(1 << b) / (high - low)!r}d), 0L), {(1 << b) - 1}L), 0L)"
        f" as bigint) as l{j}" for (j, low, high), b in zip(used, bits)
    ]
    parts = [
        f"shiftleft(shiftright(l{used[at][0]}, {bits[at] - 1 - taken}) & 1L, {CURVE_BITS - 1 - turn})"
        for turn, (at, taken) in enumerate(turns)
    ]
    coded = points.selectExpr("*", *levels).selectExpr("*", " | ".join(parts) + " as z")
    return coded.drop(*[f"l{j}" for j, _, _ in used])


def _pack(points: DataFrame, keys: list[str], ranges, rows: int, label: str) -> DataFrame:
    """One row per block: keys, block number, size, bounding box and the packed rows."""
    p = len(ranges)
    order = [*keys, "pattern", "z", "id"]
    ordered = _with_curve(points, ranges).repartitionByRange(*order).sortWithinPartitions(*order)
    cells = ", ".join(f"coalesce(x{j}, double('NaN'))" for j in range(p))
    aggs = ["bit_and(pattern) as every", "bit_or(pattern) as some", "collect_list(id) as ids",
            f"flatten(collect_list(array({cells}))) as xs", "count(1) as n"]
    aggs += [f"min(x{j}) as lo{j}" for j in range(p)] + [f"max(x{j}) as hi{j}" for j in range(p)]
    number = f"shiftright(monotonically_increasing_id(), {int(math.log2(rows))}) as block"
    blocks = ordered.selectExpr("*", number).groupBy("block", *keys).agg(*[F.expr(a) for a in aggs])
    # A block number can be shared by the last rows of one key and the first of the next.
    name = ", ".join(f"coalesce(cast({k} as string), '?')" for k in keys)
    return materialize(blocks.selectExpr("*", f"concat_ws('/', block, {name}) as name"), label)


def build_donors(points: DataFrame, ranges: list[list[float]], k: int) -> DataFrame:
    """Packed donor table. Of donors equal in everything only the k lowest ids can ever be chosen,
    so the rest are left out; the rank filter runs before the shuffle as well."""
    same = Window.partitionBy("g", "pattern", *_xs(len(ranges))).orderBy("id")
    some = F.coalesce(*_xs(len(ranges))).isNotNull()
    kept = points.where(some).withColumn("r", F.row_number().over(same))
    return _pack(kept.where(F.col("r") <= k).drop("r"), ["g"], ranges, DONOR_ROWS, "donors")


def _boxed(df: DataFrame, side: str, p: int, extra: list[str]) -> DataFrame:
    names = ["name", "g", "every", "some", "n", *extra]
    names += [f"{e}{j}" for e in ("lo", "hi") for j in range(p)]
    return df.select(*[F.col(c).alias(f"{side}_{c}") for c in names])


def _usable(p: int) -> Column:
    """A donor of the node may share a column with the receiver and hold the target."""
    if p > PATTERN_BITS:
        return F.lit(True)
    return F.expr(
        f"bit_count(r_some & d_some) > 0 and (r_target = {ANY} or (shiftright(d_some, r_target) & 1) = 1)")


def _least_distance(p: int) -> Column:
    """Squared distance below which no pair of the two boxes can be. Only columns that all rows of
    both have are counted, and the weight is that of the most columns any pair can share."""
    gaps = " + ".join(
        f"if((shiftright(r_every & d_every, {j}) & 1) = 1, "
        f"pow(greatest(0d, d_lo{j} - r_hi{j}, r_lo{j} - d_hi{j}), 2), 0d)" for j in range(min(p, PATTERN_BITS)))
    return F.expr(f"({gaps})" + ("" if p > PATTERN_BITS else f" * {p}d / bit_count(r_some & d_some)"))


def _centre_distance(p: int) -> Column:
    """Closeness of two boxes, for choosing a seed."""
    return F.expr(" + ".join(
        f"pow(coalesce(d_lo{j} + d_hi{j} - r_lo{j} - r_hi{j}, 0d), 2)" for j in range(p)))


def _numbered(donors: DataFrame) -> tuple[DataFrame, int]:
    """Donor blocks with numbers without gaps in place of the ones that their tasks gave, and how many
    numbers there are. One count per task of the sort comes to the driver."""
    bits = 33 - int(math.log2(DONOR_ROWS))
    part, inside = F.shiftright("block", bits), F.col("block").bitwiseAND(F.lit((1 << bits) - 1))
    counts = donors.groupBy(part.alias("part")).agg((F.max(inside) + 1).alias("n")).orderBy("part").collect()
    first, total = [], 0
    for r in counts:
        first.append((r["part"], total))
        total += r["n"]
    offsets = donors.sparkSession.createDataFrame(first, "part long, first long")
    placed = donors.join(F.broadcast(offsets), part == F.col("part"))
    return placed.withColumn("block", F.col("first") + inside).drop("part", "first"), total


def _levels(donors: DataFrame, p: int) -> list[DataFrame]:
    """Nodes from the donor blocks up: d_name, d_up (name of the node above), box and size."""
    numbered, total = _numbered(donors)
    fine = _boxed(numbered, "d", p, ["block"])
    levels, shift = [fine], 0
    while (total >> shift) > TOP_NODES:
        shift += FAN
        name = F.concat_ws("/", F.shiftright("d_block", FAN), "d_g")
        below = levels[-1].withColumn("d_up", name)
        levels[-1] = below
        levels.append(materialize(below.groupBy(F.col("d_up").alias("d_name"), "d_g", F.shiftright("d_block", FAN).alias("d_block")).agg(
            F.sum("d_n").alias("d_n"), F.bit_and("d_every").alias("d_every"), F.bit_or("d_some").alias("d_some"),
            *[F.min(f"d_lo{j}").alias(f"d_lo{j}") for j in range(p)],
            *[F.max(f"d_hi{j}").alias(f"d_hi{j}") for j in range(p)]), "nodes"))
    return levels


class _Donors:
    """The donors that a tile holds, cut into leaves of at most `LEAF_ROWS`: rows of one pattern of present columns are
    halved along their longest side until they fit; patterns of a few rows are taken together. Up to `BRANCH`
    leaves in a row are a node. Cells are taken from their column's mean, so that products lose few digits."""

    def __init__(self, ids: np.ndarray, xs: np.ndarray):
        n, p = xs.shape
        has = ~np.isnan(xs)
        self.centre = np.where(has, xs, 0.0).sum(0) / np.maximum(has.sum(0), 1)
        plain = np.where(has, xs - self.centre, 0.0)
        _, code, counts = np.unique(has @ (1 << (np.arange(p) % PATTERN_BITS)), return_inverse=True, return_counts=True)
        code = np.where(counts[code] < LEAF_ROWS // 2, -1, code)
        order = np.argsort(code, kind="stable")
        tree = np.flatnonzero(np.diff(code[order], prepend=-2))  # first row of each pattern
        start = tree
        while True:
            rows = np.diff(start, append=n)
            big = np.flatnonzero(rows > LEAF_ROWS)
            if not len(big):
                break
            inside = np.repeat(rows > LEAF_ROWS, rows)
            part, size = order[inside], rows[big]
            first = np.cumsum(size) - size
            cells = plain[part]
            side = (np.maximum.reduceat(cells, first) - np.minimum.reduceat(cells, first)).argmax(1)
            which = np.repeat(np.arange(len(big)), size)
            order[inside] = part[np.lexsort((cells[np.arange(len(part)), side[which]], which))]
            start = np.sort(np.concatenate([start, start[big] + size // 2]))
        self.ids, self.xs, self.has, plain = ids[order], xs[order], has[order], plain[order]
        self.start, self.ends = start, np.append(start[1:], n)
        self.cells = np.concatenate([self.has.astype(float), plain, plain**2], 1)  # 0 where the cell is missing
        self.largest = float((plain**2).sum(1).max(initial=0.0))
        self.some, every = (f.reduceat(self.has, start) for f in (np.logical_or, np.logical_and))
        self.low = np.where(every, np.minimum.reduceat(plain, start), -np.inf)
        self.high = np.where(every, np.maximum.reduceat(plain, start), np.inf)
        count = np.add.reduceat(self.has, start, dtype=float)
        self.middle = np.add.reduceat(plain, start) / np.maximum(count, 1)
        in_tree = np.searchsorted(tree, start, "right") - 1
        inside = np.arange(len(start)) - np.searchsorted(in_tree, in_tree)  # number of a leaf in its tree
        self.node = np.flatnonzero(inside % BRANCH == 0)  # first leaf of each node
        self.leaves = np.diff(self.node, append=len(start))
        self.node_some = np.logical_or.reduceat(self.some, self.node)
        self.node_low, self.node_high = np.minimum.reduceat(self.low, self.node), np.maximum.reduceat(self.high, self.node)


class _Best:
    """The k best donors so far of each row of receiver blocks."""

    def __init__(self, ids, xs: np.ndarray, target: int, bound: float | np.ndarray, k: int, exclude_self: bool):
        self.ids, self.xs, self.target, self.k, self.exclude_self = ids, xs, target, k, exclude_self
        self.limit = np.array(np.broadcast_to(bound, len(ids)), float)  # no donor further away can be among the k best
        self.has = ~np.isnan(xs)
        self.at, self.d2, self.donor, self.value = (np.empty(0, t) for t in (np.int64, float, np.int64, float))

    def add(self, ids: np.ndarray, xs: np.ndarray, least: float) -> None:
        if least <= self.limit.max() * SLACK:
            self.search(_Donors(ids, xs))

    def search(self, donors: _Donors) -> None:
        """Meet the donors: the nearest leaves of a row bound its k-th distance, then it meets every leaf whose box
        is within. Pairs are told by products, which are a little off, so limits are widened by more than that."""
        p = self.xs.shape[1]
        plain = np.where(self.has, self.xs - donors.centre, 0.0)
        square, held = plain**2, self.has.astype(float)
        slack = 1e-13 * p * p * (square.sum(1) + donors.largest)
        self._bound(donors, np.concatenate([square, -2 * plain, held], 1), slack)
        limit = np.minimum(self.limit * SLACK + 2 * slack, FAR)
        told = np.concatenate([square - held * (limit / p)[:, None], -2 * plain, held], 1)
        place, pairs = np.where(self.has, plain, np.nan), []
        for a in range(0, len(plain), BESIDE_ROWS):
            pairs.append(self._beside(donors, place, held, limit, slice(a, a + BESIDE_ROWS)))
            if a + BESIDE_ROWS >= len(plain) or sum(len(rows) for rows, _ in pairs) > PAIRS:
                self._meet(donors, told, slack, *map(np.concatenate, zip(*pairs)))
                pairs = []

    def _bound(self, donors: _Donors, own: np.ndarray, slack: np.ndarray) -> None:
        """Limits from the leaves with the nearest middles."""
        p, n = self.xs.shape[1], len(self.ids)
        most = min(SEEDS, len(donors.start))
        theirs = np.concatenate([donors.some, np.where(donors.some, donors.middle, 0.0), np.where(donors.some, donors.middle**2, 0.0)], 1)
        best = np.full((n, most * self.k), np.inf)
        for a in range(0, n, BESIDE_ROWS):
            rows = slice(a, a + BESIDE_ROWS)
            shared = own[rows, 2 * p:] @ donors.some.T
            away = np.where(shared > 0, own[rows] @ theirs.T / np.maximum(shared, 1.0), np.inf)
            if self.target != ANY:
                away[:, ~donors.some[:, self.target]] = np.inf
            near = np.argpartition(away, most - 1, axis=1)[:, :most] if most < away.shape[1] else np.tile(np.arange(most), (len(away), 1))
            flat = near.reshape(-1)
            order = np.argsort(flat, kind="stable")
            for few in np.split(order, np.flatnonzero(np.diff(flat[order])) + 1):
                leaf, of = flat[few[0]], a + few // most
                part = slice(donors.start[leaf], donors.ends[leaf])
                shared = own[of, 2 * p:] @ donors.cells[part, :p].T
                about = np.where(shared > 0, own[of] @ donors.cells[part].T * (p / np.maximum(shared, 1.0)), np.inf)
                if self.target != ANY:
                    about[:, ~donors.has[part, self.target]] = np.inf
                if self.exclude_self:
                    about[self.ids[of][:, None] == donors.ids[part]] = np.inf
                if about.shape[1] > self.k:
                    about = np.partition(about, self.k - 1, axis=1)[:, :self.k]
                columns = (few % most)[:, None] * self.k + np.arange(about.shape[1])
                best[of[:, None], columns] = about
        last = np.partition(best, self.k - 1, axis=1)[:, self.k - 1] + p * slack
        self.limit = np.minimum(self.limit, np.maximum(last, 0.0))

    def _beside(self, donors: _Donors, place: np.ndarray, held: np.ndarray, limit: np.ndarray, rows: slice) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) whose box is within the row's limit, by way of the nodes."""
        p = place.shape[1]
        x, mine, bound = place[rows], held[rows], limit[rows]
        shared = mine @ donors.node_some.T
        total = np.zeros(shared.shape)
        there = np.flatnonzero(mine.any(axis=0))
        for j in there:
            gap = np.fmax(np.fmax(donors.node_low[:, j] - x[:, j:j + 1], x[:, j:j + 1] - donors.node_high[:, j]), 0.0)
            total += gap * gap
        at, node = np.nonzero((shared > 0) & (total * p <= bound[:, None] * SLACK * shared))
        count = donors.leaves[node]
        at = np.repeat(at, count)
        leaf = np.repeat(donors.node[node] - (np.cumsum(count) - count), count) + np.arange(len(at))
        shared, total = np.zeros(len(at)), np.zeros(len(at))
        for j in there:
            v = x[:, j].take(at)
            gap = np.fmax(np.fmax(donors.low[:, j].take(leaf) - v, v - donors.high[:, j].take(leaf)), 0.0)
            total += gap * gap
            shared += mine[:, j].take(at) * donors.some[:, j].take(leaf)
        ok = (shared > 0) & (total * p <= bound.take(at) * SLACK * shared)
        if self.target != ANY:
            ok &= donors.some[:, self.target].take(leaf)
        return at[ok] + rows.start, leaf[ok]

    def _meet(self, donors: _Donors, told: np.ndarray, slack: np.ndarray, rows: np.ndarray, leaves: np.ndarray) -> None:
        order = np.argsort(leaves, kind="stable")
        rows, leaves = rows[order], leaves[order]
        found, many = [], 0
        for few in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(leaves)) + 1) if len(rows) else []:
            leaf, of = leaves[few[0]], rows[few[0]:few[-1] + 1]
            first, last = donors.start[leaf], donors.ends[leaf]
            near = np.flatnonzero(told[of] @ donors.cells[first:last].T <= slack[of][:, None])
            at, donor = of[near // (last - first)], first + near % (last - first)
            found.append((at, donor))
            many += len(at)
            if many > PAIRS:
                self._keep(donors, found)
                found, many = [], 0
        if many:
            self._keep(donors, found)

    def _keep(self, donors: _Donors, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Measure the pairs and keep the k best of each row."""
        at, of = map(np.concatenate, zip(*found))
        ok = np.ones(len(at), bool)
        if self.target != ANY:
            ok &= donors.has[of, self.target]
        if self.exclude_self:
            ok &= self.ids[at] != donors.ids[of]
        at, of = at[ok], of[ok]
        d2 = _distances(self.xs[at], donors.xs[of])
        in_reach = np.isfinite(d2) & (d2 <= self.limit[at] * SLACK)
        at, of, d2 = at[in_reach], of[in_reach], d2[in_reach]
        if not len(at):
            return
        # only receivers with a new candidate are ranked anew
        touched = np.zeros(len(self.ids), bool)
        touched[at] = True
        old = touched[self.at]
        values = donors.xs[of, self.target] if self.target != ANY else np.zeros(len(of))
        new = [np.concatenate([a[old], b]) for a, b in zip((self.at, self.d2, self.donor, self.value), (at, d2, donors.ids[of], values))]
        order = np.lexsort((new[2], new[1], new[0]))
        new = [a[order] for a in new]
        start = np.flatnonzero(np.diff(new[0], prepend=-1))
        place = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        last = place == self.k - 1
        self.limit[new[0][last]] = np.minimum(self.limit[new[0][last]], new[1][last])
        kept = place < self.k
        self.at, self.d2, self.donor, self.value = (
            np.concatenate([a[~old], b[kept]]) for a, b in zip((self.at, self.d2, self.donor, self.value), new))


def _distances(r: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows over shared columns, scaled by all / shared; inf when none is."""
    p = r.shape[1]
    total, shared = np.zeros(len(r)), np.zeros(len(r))
    for j in range(p):
        gap = r[:, j] - d[:, j]
        gap *= gap
        there = ~np.isnan(gap)
        shared += there
        total += np.where(there, gap, 0.0)
    return np.where(shared > 0, total * (p / np.maximum(shared, 1.0)), np.inf)


def _met(batches: Iterator[pa.RecordBatch], p: int, k: int, exclude_self: bool) -> Iterator[tuple[list[tuple[str, int]], _Best]]:
    """Receiver blocks (name, rows) after they have met the donor blocks of a tile. The donor blocks of a tile come
    first and are held, at most `SHARE` of them on average; its receiver blocks follow, and those of one target
    search together, up to `TOGETHER_ROWS`."""
    tile, held, donors, wanted, waiting = None, [], None, set(), []

    def searched() -> Iterator[tuple[list[tuple[str, int]], _Best]]:
        if waiting:
            names, targets, ids, xs, limits = zip(*waiting)
            best = _Best(np.concatenate(ids), np.concatenate(xs), targets[0], np.concatenate(limits), k, exclude_self)
            best.search(donors)
            yield [(name, len(i)) for name, i in zip(names, ids)], best
            waiting.clear()

    for b in batches:
        tiles, names, own = (b[c].to_pylist() for c in ("tile", "r_name", "own"))
        for i in range(b.num_rows):
            if tiles[i] != tile:
                yield from searched()
                tile, held, donors, wanted = tiles[i], [], None, set()
            ids = b["ids"][i].values.to_numpy(zero_copy_only=False)
            xs = b["xs"][i].values.to_numpy(zero_copy_only=False).reshape(-1, p)
            if own[i] == 0:
                wanted.update(want["r_name"] for want in b["wants"][i].as_py())
                held.append((ids, xs))
            elif names[i] in wanted:
                if donors is None:
                    donors, held = _Donors(*map(np.concatenate, zip(*held))), []
                target, limits = b["target"][i].as_py(), b["limits"][i]
                if waiting and (waiting[0][1] != target or sum(len(w[2]) for w in waiting) + len(ids) > TOGETHER_ROWS):
                    yield from searched()
                limits = limits.values.to_numpy(zero_copy_only=False) * SLACK if limits.is_valid else np.full(len(ids), np.inf)
                waiting.append((names[i], target, ids, xs, limits))
    yield from searched()


def _bounds_kernel(p: int, k: int, exclude_self: bool):
    """Per receiver block: the k-th distances of its rows among the donors met, and the largest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks, best in _met(batches, p, k, exclude_self):
            limits = np.split(best.limit, np.cumsum([n for _, n in blocks])[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name for name, _ in blocks]), pa.array([float(v.max()) for v in limits]), pa.array(limits, pa.list_(pa.float64()))],
                names=["r_name", "bound", "limits"])

    return run


def _neighbours_kernel(p: int, k: int, exclude_self: bool):
    """Per receiver: the k best donors met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, best in _met(batches, p, k, exclude_self):
            target = np.full(len(best.at), best.target, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.ids[best.at], target, best.donor, best.d2, best.value)],
                                             names=["id", "target", "donor", "d2", "value"])

    return run


def _meeting(packed: DataFrame, bounds: DataFrame, pairs: DataFrame, donors: DataFrame, few: bool = False) -> DataFrame:
    """Rows for `_met`, tile by tile, from `pairs` (r_name, d_name, least). A tile is a run of receiver blocks and a
    share of the donor blocks that any of them meets; it grows with the search, so that blocks travel seldom.
    Where every receiver block has only a `few` donor blocks it is a tile with them."""
    # a donor costs a task far less than a receiver, which meets the fewer donors the more of them are sorted at once
    bits = 0 if few else max(0, min(TILE_BITS, int(math.log2(max(pairs.count(), 1) / TILES / 8) / 2)))
    most = 1 << (FAN + 1) if few else SHARE
    run = F.concat_ws("/", F.shiftright("block", bits).cast("string"), "g")
    runs = packed.select(F.col("name").alias("r_name"), run.alias("run"))
    wants = materialize(pairs.join(runs, "r_name").groupBy("run", "d_name").agg(
        F.collect_list(F.struct("least", "r_name")).alias("wants")), "wants")
    shares = wants.groupBy("run").agg(F.ceil(F.count(F.lit(1)) / min(SHARE, most)).cast("int").alias("shares"))
    shares = materialize(shares, "shares")  # one row per run
    tile = F.concat_ws("/", "share", "run").alias("tile")
    cells = donors.select(F.col("name").alias("d_name"), "ids", "xs")
    dealt = wants.join(shares, "run").withColumn("share", F.pmod(F.xxhash64("d_name"), F.col("shares")))
    theirs = dealt.join(cells, "d_name").select(tile, F.lit(0).alias("own"), F.col("d_name").alias("r_name"), "wants", "ids", "xs")
    own = packed.withColumn("run", run).join(shares, "run").join(bounds.withColumnRenamed("r_name", "_r"), F.col("name") == F.col("_r"), "left") \
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))) \
        .select(tile, F.lit(1).alias("own"), F.col("name").alias("r_name"), "target", "limits", "ids", "xs")
    # a tile is little data and much work, so tasks are made by number and not by size
    tasks = max(1, min(shares.agg(F.sum("shares")).first()[0] or 0, 4 * TILES if few else 1 << 20))
    every = theirs.unionByName(own, allowMissingColumns=True).repartition(tasks, "tile").sortWithinPartitions("tile", "own", "r_name")
    return every.select("tile", "own", "r_name", "wants", "target", "limits", "ids", "xs")


def nearest(
    receivers: DataFrame, donors: DataFrame, ranges: list[list[float]], k: int, exclude_self: bool = False,
) -> DataFrame:
    """(id, target, donor, d2, value): the k nearest donors of every receiver and target.

    `receivers` holds points with a `target` column (`ANY` or a column number); `donors` is the
    table of `build_donors`, built with at least k, or k + 1 when a row may not find itself.
    """
    p = len(ranges)
    packed = _pack(receivers, ["g", "target"], ranges, RECEIVER_ROWS, "receivers")
    r_box = _boxed(packed, "r", p, ["target"])
    levels = _levels(donors, p)
    same_group, usable = F.col("r_g") == F.col("d_g"), _usable(p)
    bounds = receivers.sparkSession.createDataFrame([], "r_name string, bound double, limits array<double>")
    if len(levels) > 1:
        enough = F.col("d_n") >= k + int(exclude_self)
        near = F.min_by("d_name", _centre_distance(p)).alias("node")
        chosen = r_box.join(levels[-1], same_group & usable & enough).groupBy("r_name").agg(near)
        for level in reversed(levels[1:-1]):
            below = r_box.join(chosen, "r_name").join(level, F.col("node") == F.col("d_up"))
            deeper = below.where(usable & enough).groupBy("r_name").agg(near.alias("deeper"))
            chosen = chosen.join(deeper, "r_name").select("r_name", F.col("deeper").alias("node"))
        seeds = r_box.join(chosen, "r_name").join(levels[0], F.col("node") == F.col("d_up")).where(usable) \
            .select("r_name", "d_name", _least_distance(p).alias("least"))
        bounds = materialize(_meeting(packed, bounds, materialize(seeds, "seeds"), donors, few=True).mapInArrow(
            _bounds_kernel(p, k, exclude_self), "r_name string, bound double, limits array<double>"), "bounds")
        # parts of a receiver block's seeds may have been measured apart; any of them is a bound
        bounds = bounds.groupBy("r_name").agg(F.min("bound").alias("bound"), F.min_by("limits", "bound").alias("limits"))
    # a block without a seed has too few donors for a bound and keeps all of them
    reach = r_box.join(bounds.drop("limits"), "r_name", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))) * SLACK)
    close = usable & (_least_distance(p) <= F.col("bound"))
    pairs = reach.join(levels[-1], same_group & close).select("r_name", "d_name", _least_distance(p).alias("least"))
    for level in reversed(levels[:-1]):
        on = (F.col("node") == F.col("d_up")) & close
        pairs = pairs.select("r_name", F.col("d_name").alias("node")).join(reach, "r_name") \
            .join(level, on).select("r_name", "d_name", _least_distance(p).alias("least"))
    pairs = materialize(pairs, "pairs")
    found = _meeting(packed, bounds, pairs, donors).mapInArrow(
        _neighbours_kernel(p, k, exclude_self), "id bigint, target int, donor bigint, d2 double, value double")
    best = Window.partitionBy("id", "target").orderBy("d2", "donor")
    return found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")


def fit_imputer(
    train: DataFrame, key: str, cols: list[str], k: int = 5, group: str | None = None,
) -> "KnnImputerModel":
    """With a group the columns are standardised inside it and donors come from it alone; without
    one the whole table is used unscaled."""
    means = scale_statistics(train, cols, "standard")
    numbers = {"key": key, "columns": cols, "k": k, "group": group, "fallback": means}
    tables = {}
    scaled, key = whole_key(train, key)
    if group is not None:
        tables["scale"] = group_statistics(train.where(col(group).isNotNull()), group, cols)
        scaled = scale_in_group(scaled, tables["scale"], group, cols, means)
    points = _points(scaled, key, group, cols)
    numbers["ranges"] = _ranges(points, len(cols))
    tables["donors"] = build_donors(points, numbers["ranges"], k)
    return KnnImputerModel(numbers, tables)


class KnnImputerModel(StateModel):
    """Mean of the k nearest donors; without a usable donor, the training mean of the group."""

    def _transform(self, df: DataFrame) -> DataFrame:
        n = self.numbers
        cols, group, means = n["columns"], n["group"], n["fallback"]
        columns = df.columns
        df, key = whole_key(df, n["key"])
        gaps = any_null(cols)
        whole, broken = df.where(~gaps), df.where(gaps)
        work = broken
        if group is not None:
            work = scale_in_group(broken, self.tables["scale"], group, cols, means)
        points = _points(work, key, group, cols)
        missing = F.array_compact(F.array(*[
            F.when(F.col(x).isNull(), F.lit(j)) for j, x in enumerate(_xs(len(cols)))
        ]))
        receivers = points.withColumn("target", F.explode(missing))
        found = nearest(receivers, self.tables["donors"], n["ranges"], n["k"])
        wide = found.groupBy(F.col("id").alias("__id")).agg(*[
            F.avg(F.when(F.col("target") == j, F.col("value"))).alias(f"__f{j}") for j in range(len(cols))
        ])
        wide = materialize(wide, "fills")  # later fits scan the result often; the search runs once
        filled = work.join(wide, col(key).cast("bigint") == F.col("__id"), "left")
        no_donor = {c: F.lit(0.0) if group is not None else F.lit(means[c][0] if c in means else None).cast("double") for c in cols}
        new = {c: F.coalesce(col(c).cast("double"), F.col(f"__f{j}"), no_donor[c]) for j, c in enumerate(cols)}
        filled = filled.select(*replace(df, new))
        if group is not None:
            back = scale_in_group(filled, self.tables["scale"], group, cols, means, inverse=True)
            # Present cells are taken from the input, free of the round trip.
            before = broken.select(col(key), *[col(c).alias(f"__b{j}") for j, c in enumerate(cols)])
            filled = back.join(before, key).select(*replace(df, {
                c: F.coalesce(F.col(f"__b{j}").cast("double"), col(c)) for j, c in enumerate(cols)}))
        doubles = {c: col(c).cast("double") for c in cols}
        return whole.select(*replace(df, doubles)).unionByName(filled).select(*[col(c) for c in columns])
