"""Near-duplicate documents by HyperMinHash.

1. Sketch. A document's shingles are hashed once; each hash picks one of `BUCKETS` buckets, which keeps
   the smallest rest. A register stores that rest as a leading-zero count and `MANTISSA` bits. An empty
   bucket takes the register of the first full bucket on its own fixed probe sequence.
2. Equal shingle sets are one node, named by the smallest id.
3. Bands of `ROWS` registers are grouping keys. Inside a key, registers are compared: matches less the
   expected chance collisions estimate the similarity, and pairs under `PRUNE` are dropped. A task
   returns a spanning forest of the pairs that pass, so what it returns grows with the members.
4. The components of these forests are families; every link lies inside one. The full shingle sets of a
   family are compared exactly, and again only a spanning forest of the links goes on. The components of
   the links are the result.

A band key or family of any size is cut into blocks; each pair of blocks is one group of rows, so no
group and no task holds more than two blocks, and nothing is capped. Blocks of a family are bounded by
shingles and by documents, as the exact comparison holds matrices of documents. Rows and number of the bands follow
from the similarity asked for (`bands_for`): a pair at the threshold shares none of them with a probability of at most
`MISS`. Thresholds too low for any such bands are refused.

Defined results: a null or empty text has no shingle, links with nothing and is its own component;
rows of one id are one document, whatever their texts; a row with a null id may lie in a component but
never names it, and has a null component and kept = false if it has no copy with an id. Extra columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tabloom.llm import kernel
from tabloom.llm.common import components, salted_lookup
from tabloom.storage import materialize

BUCKETS = 256
#: Chance that a pair at the threshold shares no band.
MISS = 5e-8
#: A register holds four bits of leading zeros and four of the mantissa.
ZEROS, MANTISSA = 4, 4
#: Pairs whose estimate is so many standard errors under the threshold are no candidates.
ERRORS = 10
BAND_BLOCK = 1024  # members of a band key in a block
FAMILY_BLOCK = 100_000  # shingles of a family in a block
FAMILY_DOCS = 2_000  # documents of a family in a block: matrices of a pair of blocks have 4,000 rows


def bands_for(percent: int) -> tuple[int, int]:
    """Registers of a band and number of bands: the longest bands that find a pair at the threshold."""
    same = percent / 100
    for rows in range(16, 0, -1):
        chance = min(same**rows, 1 - 1e-12)
        bands = math.ceil(math.log(MISS) / math.log1p(-chance)) if chance > 0 else BUCKETS + 1
        if rows * bands <= BUCKETS:
            return rows, bands
    raise ValueError(f"{BUCKETS} registers do not find pairs of similarity {same}")


def prune_at(percent: int) -> float:
    same = percent / 100
    return max(0.0, same - ERRORS * math.sqrt(same * (1 - same) / BUCKETS))


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block: first text, number of texts, and the distinct (text, shingle hash) pairs in order.
    Letters A-Z count as a-z; a text of fewer than `size` words is one shingle."""
    for w in kernel.blocks(column, lower=True):
        h, at = w.grams(size)
        text = w.text[at]
        few = w.per_text()
        for n in range(1, size):
            short = np.flatnonzero(few == n)
            if len(short):
                g, first = w.grams(n)
                one = np.isin(w.text[first], short)
                text, h = np.concatenate([text, w.text[first][one]]), np.concatenate([h, g[one]])
        t, k, _ = kernel.distinct(text, h)
        yield w.first, w.n, t, k


def registers(n: int, text: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of `n` sets, one row each; rows of empty sets are zero."""
    h = kernel.mix(shingle ^ np.uint64(0x5851F42D4C957F2D))
    bucket = (h >> np.uint64(56)).astype(np.int64)
    rest = h & np.uint64((1 << 56) - 1)
    low = np.full(n * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, text * BUCKETS + bucket, rest)
    full = (low != np.iinfo(np.uint64).max)
    value = np.maximum(low, np.uint64(1))
    # position of the leading one, exact for 56 bits as the low bits are cut off first
    exponent = np.frexp((value >> np.uint64(8)).astype(np.float64))[1] + 8
    small = value < np.uint64(256)
    exponent[small] = np.frexp(value[small].astype(np.float64))[1]
    zeros = np.minimum(56 - exponent, (1 << ZEROS) - 1)
    shift = np.maximum(exponent - 1 - MANTISSA, 0).astype(np.uint64)
    mantissa = (value >> shift) & np.uint64((1 << MANTISSA) - 1)
    out = ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint8)
    out[~full] = 0
    out, full = out.reshape(n, BUCKETS), full.reshape(n, BUCKETS)
    some = full.any(1)
    row, col = np.nonzero(~full & some[:, None])
    step = 0
    while len(row):
        step += 1
        probe = (kernel.mix(col.astype(np.uint64) + np.uint64(step << 32)) >> np.uint64(56)).astype(np.int64)
        hit = full[row, probe]
        out[row[hit], col[hit]] = out[row[hit], probe[hit]]
        row, col = row[~hit], col[~hit]
    return out


def _cells() -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends, as shares of the bucket's range, of the rests that give each register."""
    level = 2.0 ** -(np.arange(1 << ZEROS) + 1.0)
    step = np.arange((1 << MANTISSA) + 1) / (1 << MANTISSA)
    edge = level[:, None] * (1 + step[None, :])
    low, high = edge[:, :-1].ravel().copy(), edge[:, 1:].ravel()
    low[-(1 << MANTISSA)] = 0.0
    return low, high


_LOW, _HIGH = _cells()


def chances(size: np.ndarray) -> np.ndarray:
    """Chance of each register value in a bucket, one row for each set size."""
    per = np.maximum(size.astype(np.float64) / BUCKETS, 1.0)[:, None]
    return np.exp(-per * _LOW) - np.exp(-per * _HIGH)


def estimate(matches: np.ndarray, collision: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for chance collisions: the
    product sum of both sets' register chances."""
    return (matches / BUCKETS - collision) / (1 - collision)


def forest(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of n nodes, each component a tree around its first node;
    `near(node, others)` tells which of the others it links with. Nodes reached are not asked about again."""
    left = np.arange(n)
    edges = []
    while len(left):
        root, left = int(left[0]), left[1:]
        stack = [root]
        while stack and len(left):
            ok = near(stack.pop(), left)
            found, left = left[ok].tolist(), left[~ok]
            stack += found
            edges += [(root, x) for x in found]
    return edges


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups by their first `keys` long columns, with the groups' bounds."""
    held: list[pa.RecordBatch] = []

    def cut(t: pa.Table) -> np.ndarray:
        new = np.zeros(max(t.num_rows - 1, 0), bool)
        for k in range(keys):
            v = t.column(k).to_numpy()
            new |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1, [t.num_rows]])

    for batch in kernel.empty_batches(batches):
        held.append(batch)
        t = pa.Table.from_batches(held)
        bounds = cut(t)
        if len(bounds) > 2:
            yield t.slice(0, bounds[-2]), bounds[:-1]
            held = t.slice(bounds[-2]).to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield t, cut(t)


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both.min(1)), pa.array(both.max(1))], names=["a", "b"])


def _signatures(n: int, text: np.ndarray, shingle: np.ndarray) -> pa.Array:
    """128 bits for each set, null where it is empty."""
    sums = np.zeros((n, 2), np.uint64)
    np.add.at(sums[:, 0], text, kernel.mix(shingle))
    np.add.at(sums[:, 1], text, kernel.mix(shingle * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)))
    return pa.array([r.tobytes() if c else None for r, c in zip(sums, np.bincount(text, minlength=n))], pa.binary())


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            for first, n, text, shingle in shingle_sets(batch.column(1), size):
                count = np.bincount(text, minlength=n)
                regs = registers(n, text, shingle)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(count.astype(np.int64)),
                    _signatures(n, text, shingle),
                    pa.array([r.tobytes() for r in regs], pa.binary())], names=["doc_id", "n", "sig", "regs"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, sig binary, regs binary")


def _band_keys(reps: DataFrame, percent: int) -> DataFrame:
    length, bands = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, BUCKETS)
            parts = regs[:, :length * bands].reshape(-1, bands, length)
            key = np.tile(np.arange(bands, dtype=np.uint64) << np.uint64(50), (len(regs), 1))
            for low in range(0, length, 6):  # up to six registers at a time
                piece = parts[:, :, low:low + 6].astype(np.uint64)
                weight = np.uint64(256) ** np.arange(piece.shape[2], dtype=np.uint64)
                key = kernel.mix((piece * weight).sum(2, dtype=np.uint64) + key)
            key = key.astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), bands))], names=["key", "node"])

    return reps.select("node", "regs").mapInArrow(run, "key long, node long")


def _block_pairs(rows: DataFrame, group: str, blocks: str, spread: str) -> DataFrame:
    """Rows of a group with `blocks` blocks, once for every pair of blocks that theirs belongs to, in
    whole pairs inside sorted partitions."""
    own = F.pmod(F.xxhash64(spread), F.col(blocks))
    paired = rows.withColumn("own", own) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))) \
        .withColumn("x", F.least("own", "_other")).withColumn("y", F.greatest("own", "_other")) \
        .drop("_other", blocks)
    return paired.repartition(group, "x", "y").sortWithinPartitions(group, "x", "y")


def _candidate_forest(members: DataFrame, percent: int) -> DataFrame:
    least = prune_at(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in whole_groups(batches, 3):
            node, size, own = (t.column(k).to_numpy() for k in ("node", "n", "own"))
            x, y = t.column("x").to_numpy(), t.column("y").to_numpy()
            regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint8).reshape(-1, BUCKETS)
            count = np.diff(bounds)
            two = bounds[:-1][count == 2]
            same = np.count_nonzero(regs[two] == regs[two + 1], axis=1)
            collision = (chances(size[two]) * chances(size[two + 1])).sum(1)
            good = two[estimate(same, collision) >= least]
            found = list(zip(node[good].tolist(), node[good + 1].tolist()))
            for g in np.flatnonzero(count > 2):
                at = slice(bounds[g], bounds[g + 1])
                r, chance, side, ids = regs[at], chances(size[at]), own[at], node[at]
                across = x[bounds[g]] != y[bounds[g]]

                def near(i, others, r=r, chance=chance, side=side, across=across):
                    same = np.count_nonzero(r[others] == r[i], axis=1)
                    ok = estimate(same, chance[others] @ chance[i]) >= least
                    return ok & (side[others] != side[i]) if across else ok

                found += [(int(ids[i]), int(ids[j])) for i, j in forest(len(ids), near)]
            yield _edges(found)

    return _block_pairs(members, "key", "blocks", "node").select("key", "x", "y", "own", "node", "n", "regs") \
        .mapInArrow(run, "a long, b long")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets, by products of slices of the membership matrix."""
    n = len(sets)
    if n <= 4:
        out = np.zeros((n, n), np.int64)
        for i in range(n):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    item = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(item, kind="stable")
    item, row = item[order], row[order]
    new = np.concatenate([[True], item[1:] != item[:-1]])
    code = np.cumsum(new) - 1
    often = np.bincount(code) > 1
    rank = np.cumsum(often) - 1
    keep = often[code]
    code, row = rank[code[keep]], row[keep]
    out = np.zeros((n, n), np.float64)
    total = int(often.sum())
    for low in range(0, total, 4096):
        a, b = np.searchsorted(code, [low, low + 4096])
        part = np.zeros((n, min(4096, total - low)), np.float32)
        part[row[a:b], code[a:b] - low] = 1.0
        out += part @ part.T
    return out.astype(np.int64)


def _verified_forest(docs: DataFrame, families: DataFrame, size: int, percent: int) -> DataFrame:
    """Links with 100 * intersection >= percent * union inside families (node, family, blocks)."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            for first, n, text, shingle in shingle_sets(batch.column(0), size):
                cut = np.searchsorted(text, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(first, n) for k in (1, 2, 3)]
                    + [pa.array([shingle[cut[i]:cut[i + 1]].tobytes() for i in range(n)], pa.binary())],
                    names=["node", "family", "blocks", "items"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, bounds in whole_groups(batches, 3):
            node, own, x, y = (t.column(k).to_numpy() for k in ("node", "own", "x", "y"))
            found = []
            for g in range(len(bounds) - 1):
                at = slice(bounds[g], bounds[g + 1])
                group = [np.frombuffer(v, np.uint64) for v in t.column("items").slice(bounds[g], bounds[g + 1] - bounds[g]).to_pylist()]
                count = np.array([len(v) for v in group])
                shared = shared_counts(group)
                ok = shared > 0
                for i in range(len(ok)):  # row by row: no more matrices of this size
                    ok[i] &= 100 * shared[i] >= percent * (count[i] + count - shared[i])
                np.fill_diagonal(ok, False)
                if x[bounds[g]] != y[bounds[g]]:
                    ok &= own[at][:, None] != own[at][None, :]
                ids = node[at]
                found += [(int(ids[i]), int(ids[j])) for i, j in forest(len(ids), lambda i, o, ok=ok: ok[i, o])]
            yield _edges(found)

    text = docs.select(F.col("doc_id").alias("node"), "text").join(families.hint("merge"), "node").select("text", "node", "family", "blocks")
    rows = text.mapInArrow(sets, "node long, family long, blocks long, items binary")
    return _block_pairs(rows, "family", "blocks", "node").select("family", "x", "y", "own", "node", "items") \
        .mapInArrow(run, "a long, b long")


def _family_blocks(members: DataFrame) -> DataFrame:
    """component, blocks: as many as its shingles and its documents (node, n, component) ask for."""
    by_shingles, by_docs = F.ceil(F.sum("n") / FAMILY_BLOCK), F.ceil(F.count(F.lit(1)) / FAMILY_DOCS)
    return members.groupBy("component").agg(F.greatest(by_shingles, by_docs).cast("long").alias("blocks"))


def _found(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n, sig (of the set) and component of every row."""
    sketch = materialize(_sketch(docs, size), "sketch")
    copies = sketch.where("n > 0").groupBy("sig") \
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = materialize(copies.select("sig", "first_id"), "copies")
    spread = F.coalesce(F.col("doc_id"), F.col("n"))
    placed = materialize(salted_lookup(sketch, copies, "sig", spread, merge=True).withColumn(
        "node", F.coalesce("first_id", "doc_id")), "placed")

    reps = placed.where("n > 0 AND node = doc_id").select("node", "n", "regs")
    rows = materialize(_band_keys(reps, percent), "bands")
    met = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1") \
        .select("key", F.ceil(F.col("members") / BAND_BLOCK).cast("long").alias("blocks"))
    members = salted_lookup(rows, met, "key", F.col("node"), merge=True).where("blocks IS NOT NULL").join(reps.hint("merge"), "node")
    families = components(_candidate_forest(members, percent))

    weight = _family_blocks(placed.where("n > 0 AND node = doc_id").select("node", "n").join(families.hint("merge"), "node"))
    blocks = salted_lookup(families, weight, "component", F.col("node"), merge=True) \
        .select("node", F.col("component").alias("family"), "blocks")
    links = components(_verified_forest(docs, materialize(blocks, "families"), size, percent))
    return _assemble(placed, copies, links)


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept."""
    return _found(docs, size, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"))


def _assemble(placed: DataFrame, copies: DataFrame, links: DataFrame) -> DataFrame:
    """Look every row's component up: copies by their set, others by their own id."""
    of_set = copies.join(links.withColumnRenamed("node", "first_id").hint("merge"), "first_id", "left") \
        .select("sig", F.coalesce("component", "first_id").alias("of_set"))
    own = links.select(F.col("node").alias("doc_id"), F.col("component").alias("of_id"))
    found = salted_lookup(placed.select("doc_id", "n", "sig"), of_set, "sig", F.coalesce(F.col("doc_id"), F.col("n")), merge=True) \
        .join(own.hint("merge"), "doc_id", "left")
    return found.select("doc_id", "n", "sig", F.coalesce("of_set", "of_id", "doc_id").alias("component"))


def _with_set(docs: DataFrame, size: int) -> DataFrame:
    """Rows of `docs` with the signature of their set, null where it is empty."""
    at, names = docs.columns.index("text"), [*docs.columns, "_sig"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            for first, n, text, shingle in shingle_sets(batch.column(at), size):
                rows = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([*rows.columns, _signatures(n, text, shingle)], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_sig", BinaryType())]))


def keep_one(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """One row of each group, with its columns: that of the smallest id, of several rows of this id the first by
    text. A row with a null id stays if no row with an id has its set, and then one of those with the same set;
    rows without shingles that have no id all stay."""
    found = materialize(_found(docs, size, percent), "found")
    named = found.where("doc_id IS NOT NULL")
    gone = materialize(named.where("doc_id <> component").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    # rows of an id that comes more than once are told apart; all others stay as they are
    again = named.where("doc_id = component").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = materialize(again.select(F.col("doc_id").alias("_gone")), "repeated")
    with_id = docs.where("doc_id IS NOT NULL")
    out = gone.unionByName(again).hint("merge")  # copies are many: a shuffle join
    once = with_id.join(out, with_id["doc_id"] == out["_gone"], "left_anti")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    one = with_id.join(again, with_id["doc_id"] == again["_gone"], "left_semi").withColumn("_place", F.row_number().over(first)) \
        .where("_place = 1").select(*docs.columns)
    # rows without an id
    sets = named.where("n > 0").select(F.col("sig").alias("_set")).distinct()
    nameless = _with_set(docs.where("doc_id IS NULL"), size)
    nameless = nameless.join(sets, nameless["_sig"] == sets["_set"], "left_anti")
    by_set = Window.partitionBy("_sig").orderBy("text")
    other = nameless.where("_sig IS NOT NULL").withColumn("_place", F.row_number().over(by_set)).where("_place = 1")
    return once.unionByName(one).unionByName(other.select(*docs.columns)) \
        .unionByName(nameless.where("_sig IS NULL").select(*docs.columns))
