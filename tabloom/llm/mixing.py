"""Mixing sources to target weights by drawing fixed-length blocks.

The words of a source, document after document, are packed into blocks of `block` words (the last one may
be shorter). A source's target is its weight's share of all words, at most `most` times its own words,
the excess reshared by weight. Output shards draw how many blocks each source gives from multinomials:
the range of shards is halved again and again, and the half that comes first draws its counts with what
each source still owes as chances, so the sum over the shards meets each quota. Every halving has a seed of
its own, and any shard is drawn by itself from the quotas; a mix has at least `least_shards` of them,
each of `SHARD` slots at most. A source's slots run through pseudorandom permutations of its block numbers, a new one for every pass,
and blocks are joined to slots by number. No block is taken more than `most` times.

Places inside a source come from running sums per (source, chunk of ids) plus the sums of the chunks
before, so a source that holds a third of all rows is no single task. Everything is a function of the
rows and the seed: reruns agree. One row per source goes through one task; draws, documents, blocks and
slots never do.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its
own, the last; null ids and repeated rows are rows like any other; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import kernel
from tabloom.llm.common import whole, word_count
from tabloom.storage import materialize


#: Most slots of an output shard, and shards that a task draws.
SHARD, TOGETHER = 65_536, 256


@dataclass(frozen=True)
class Settings:
    block: int = 64  # words
    shard: int | None = None  # slots of an output shard; None: SHARD, or fewer in a small mix
    least_shards: int = 64
    most: int = 3
    weights: tuple[int, ...] = (1, 2, 3)
    seed: int = 20
    chunk_rows: int = 20_000  # rows of a source in one running sum
    least_chunks: int = 1024


def targets(sized: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per source: source, rank (from 1, code-point order, null last), weight, source_size, target.

    Resharing until no source is above its limit is the level at which limits and weighted shares meet;
    sources in order of limit per weight are at their limit as long as it is at most their share of what
    the ones before have left.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    ranked = total.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))) \
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in s.weights]), (F.col("rank") - 1) % len(s.weights) + 1))
    wide = "decimal(38,0)"
    size, weight = F.col("source_size").cast(wide), F.col("weight").cast(wide)
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = s.most * F.col("source_size")
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    capped = ranked.withColumns({"left": left, "rest": F.sum("weight").over(after)}) \
        .withColumn("capped", s.most * size * F.col("rest").cast(wide) <= weight * F.col("left").cast(wide))
    owed = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.when(F.col("capped"), limit)).over(everything), F.lit(0))
    share = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    return capped.withColumn("target", F.when(F.col("capped"), limit.cast("double")).otherwise(
        (F.col("weight") * owed).cast("double") / share.cast("double"))) \
        .select("source", "rank", "weight", "source_size", "docs", "target")


def permuted(slot: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(n), chosen by `key`, at `slot`: four Feistel rounds on the
    smallest even number of bits that holds n, repeated until the value is in range."""
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2, 1)
    mask = (np.int64(1) << half) - 1
    out = slot.astype(np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        low, high = out[todo] & mask[todo], out[todo] >> half[todo]
        for r in range(4):
            f = kernel.mix(low.astype(np.uint64) ^ kernel.mix(key[todo] + np.uint64(r)))
            low, high = high ^ ((f >> np.uint64(3)).astype(np.int64) & mask[todo]), low
        out[todo] = (high << half[todo]) | low
        todo = todo[out[todo] >= n[todo]]
    return out


def _halved(owed: np.ndarray, slots: int, seed: list[int]) -> np.ndarray:
    """How many of `slots` slots each source gives: a multinomial with what the sources owe as chances; what
    it would take beyond that is drawn again among the others."""
    draw = np.random.default_rng(seed)
    count = np.minimum(draw.multinomial(slots, owed / owed.sum()), owed)
    while short := slots - int(count.sum()):
        room = owed - count
        count += np.minimum(draw.multinomial(short, room / room.sum()), room)
    return count


def _shards(owed: np.ndarray, size: int, seed: int, low: int, high: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, first slot of each source, count of each source) for the shards from `low` to `high`."""
    every = -(-int(owed.sum()) // size)
    waiting = [(0, every, np.zeros_like(owed), owed)]
    while waiting:
        a, b, first, mine = waiting.pop()
        if b <= low or a >= high:
            continue
        if b - a == 1:
            yield a, first, mine
            continue
        middle = (a + b) // 2
        left = _halved(mine, (middle - a) * size, [seed, a, b])
        waiting += [(middle, b, first + left, mine - left), (a, middle, first, left)]


def _draws(sources: DataFrame, s: Settings) -> DataFrame:
    """shard, rank, blocks (of the source), first (slot of the source), count."""
    blocks = F.ceil(F.col("source_size") / s.block).cast("long")
    passes = F.floor(F.col("target") / F.col("source_size")).cast("long")
    rest = F.bround((F.col("target") - passes * F.col("source_size")) / s.block).cast("long")
    owed = sources.where("source_size > 0").select("rank", blocks.alias("blocks"), F.least(passes * blocks + rest, s.most * blocks).alias("quota"))
    one = owed.agg(F.sort_array(F.collect_list(F.struct("rank", "blocks", "quota"))).alias("owed"), F.coalesce(F.sum("quota"), F.lit(0)).alias("slots"))
    size = F.greatest(F.lit(1), F.least(F.lit(SHARD), F.ceil(F.col("slots") / s.least_shards))) if s.shard is None else F.lit(s.shard)
    ranges = one.where("slots > 0").withColumn("size", size.cast("long")) \
        .withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("slots") / F.col("size")).cast("long") - 1, F.lit(TOGETHER).cast("long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for b in kernel.empty_batches(batches) for r in b.to_pylist()):
            rank, blocks, quota = (np.array([o[k] for o in r["owed"]], np.int64) for k in ("rank", "blocks", "quota"))
            for shard, first, count in _shards(quota, r["size"], s.seed, r["at"], r["at"] + TOGETHER):
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), shard, np.int64)), pa.array(rank[at].astype(np.int32)), pa.array(blocks[at]),
                    pa.array(first[at]), pa.array(count[at])], names=["shard", "rank", "blocks", "first", "count"])

    return ranges.select("owed", "size", "at").repartition("at").mapInArrow(
        run, "shard long, rank int, blocks long, first long, count long")


def slots(sources: DataFrame, s: Settings = Settings()) -> DataFrame:
    """shard, rank, slot (of the source) and the block that it takes."""
    drawn = _draws(sources, s).repartition("shard", "rank")
    piece = 4096  # slots of a row before the permutation, so that one draw is cut over tasks
    cut = drawn.withColumn("from", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1, F.lit(piece)))) \
        .withColumn("to", F.least(F.col("from") + piece - 1, F.col("first") + F.col("count") - 1)) \
        .select("shard", "rank", "blocks", "from", "to").repartition("shard", "rank", "from")
    one = cut.select("shard", "rank", "blocks", F.explode(F.sequence("from", "to")).alias("slot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kernel.empty_batches(batches):
            rank, blocks, slot = (b.column(k).to_numpy() for k in (1, 2, 3))
            key = kernel.mix(rank.astype(np.uint64) * np.uint64(1 << 32) + (slot // blocks).astype(np.uint64) + np.uint64(s.seed << 20))
            at = permuted(slot % blocks, blocks, key)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(at)],
                                             names=["shard", "rank", "slot", "block"])

    return one.mapInArrow(run, "shard long, rank int, slot long, block long")


def place(docs: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Rows with their first word's place in the source (doc_id, rank, size, start), and the sources."""
    sized = materialize(docs.select("doc_id", "source", word_count(whole()).alias("size"),
                                    F.xxhash64("text").alias("tie")), "sized")
    sources = materialize(targets(sized, s), "sources")
    largest = sources.agg(F.max("docs")).first()[0] or 0
    chunks = max(s.least_chunks, -(-largest // s.chunk_rows))
    rows = sized.join(sources.select(F.col("source").alias("_source"), "rank"), F.col("source").eqNullSafe(F.col("_source"))) \
        .withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(chunks)))
    inside = Window.partitionBy("rank", "chunk").orderBy("doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    before = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offset = rows.groupBy("rank", "chunk").agg(F.sum("size").alias("words")) \
        .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    placed = local.join(offset.hint("merge"), ["rank", "chunk"]).select("doc_id", "rank", "size", (F.col("local") + F.col("offset")).alias("start"))
    return materialize(placed, "placed"), sources


def pieces(placed: DataFrame, s: Settings = Settings()) -> DataFrame:
    """rank, block, doc_id, size, start, first (word of the document), words: what each block holds."""
    b = F.lit(s.block).cast("long")
    end = F.col("start") + F.col("size")
    cut = placed.where("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / b).cast("long"), F.floor((end - 1) / b).cast("long"))))
    low = F.greatest("start", F.col("block") * b)
    return cut.select("rank", "block", "doc_id", "size", "start", (low - F.col("start")).alias("first"),
                      (F.least(end, (F.col("block") + 1) * b) - low).alias("words"))


def mixture(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mix itself: shard, rank, slot, block, and the block's pieces in order (doc_id, first, words)."""
    placed, sources = place(docs, s)
    held = pieces(placed, s).groupBy("rank", "block").agg(F.array_sort(F.collect_list(
        F.struct("start", "doc_id", "first", "words"))).alias("pieces"))
    return slots(sources, s).join(held.hint("merge"), ["rank", "block"])


def taken(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, taken."""
    placed, sources = place(docs, s)
    times = slots(sources, s).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    of_row = pieces(placed, s).join(times.hint("merge"), ["rank", "block"]) \
        .groupBy("rank", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken")) \
        .withColumnsRenamed({"rank": "_rank", "start": "_start"})
    found = placed.join(of_row.hint("merge"), (F.col("rank") == F.col("_rank")) & (F.col("start") == F.col("_start")) & (F.col("size") > 0), "left")
    return found.join(sources.select("source", "source_size", "target", F.col("rank").alias("_r")), F.col("rank") == F.col("_r")) \
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
