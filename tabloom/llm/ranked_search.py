"""Ranked lexical search: the documents that score highest for each item of a query set, by bags.

Terms are the maximal runs of characters other than ASCII punctuation, space and control characters,
with A-Z in lower case. Documents are restricted to the items' vocabulary: what is left of one is its
bag, the counts of those terms, and the length factor m. Documents with the same bag and the same m score
alike, so they are one class: bags are hashed, rows of equal hash are told apart by the whole bag, and
each class is scored once. The best classes of an item are expanded to their documents by ascending
doc_id.

With N documents that have a term, L terms in all, df documents with a term and n terms in a document:
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))), m = 25 + 75 * n * N div L,
    score = sum over the item's terms of w * (1000000000 * tf div (1000 * tf + 8 * m)).

Every document is read and every class is scored against every item that it shares a term with. A task
keeps the best `k` classes per item only, by score and then smallest doc_id: a class behind `k` others
has `k` documents before each of its own. Items are taken in blocks of about `POSTINGS` terms, which is
what a worker holds; a larger query set takes more passes over the documents.

Defined results: a null or empty text has no term and is in no result; repeated rows are documents of
their own, ranked next to each other; null doc_ids rank behind all others of the same score; an item
without terms has no rows; repeated rows of an item count once, and different texts under one item_id are
one item with the terms of both; an empty table on either side gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm import kernel
from tabloom.llm.common import whole
from tabloom.storage import materialize

#: Fixed value: a term, as a regular expression.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Distinct terms of items in a block (an item is never cut, so a block may hold one item more).
POSTINGS = 200_000
#: Scores held at once in a worker: classes times items.
CELLS = 1 << 20
#: Classes that are broadcast when their documents are looked up: checked, else a shuffle join.
FEW_CLASSES = 20_000
_LAST = (1 << 63) - 1


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times: how often each item holds each of its terms."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = F.regexp_extract_all(F.translate(whole(), upper, lower), F.lit(TERM), F.lit(0))
    return items.select("item_id", "text").distinct().select("item_id", F.explode(words).alias("term")) \
        .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


class Lexicon:
    """Terms of a block of items, found in texts by hash and then compared byte by byte."""

    def __init__(self, terms: list[str]):
        column = pa.array(terms, pa.string())
        hashes = np.empty(len(terms), np.uint64)
        for w in kernel.blocks(column, separator=kernel.PUNCTUATION):
            hashes[w.first + w.text] = w.hash
        raw = [t.encode() for t in terms]
        order = np.argsort(hashes, kind="stable")
        self.number, self.hash = order, hashes[order]
        self.length = np.array([len(raw[i]) for i in order], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(raw[i] for i in order), np.uint8)
        self.twins = int(np.unique(self.hash, return_counts=True)[1].max(initial=0))  # most terms of one hash

    def find(self, w: kernel.Words) -> tuple[np.ndarray, np.ndarray]:
        """Text and term number of each word of a block that is a term, in the order of the texts."""
        texts, numbers = [], []
        low = np.searchsorted(self.hash, w.hash)
        for k in range(self.twins):
            at = np.minimum(low + k, len(self.hash) - 1)
            hit = np.flatnonzero((self.hash[at] == w.hash) & (low + k < len(self.hash)))
            hit = hit[self.length[at[hit]] == w.end[hit] - w.start[hit]]
            size = self.length[at[hit]]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            differs = w.data[np.repeat(w.start[hit], size) + inside] != self.data[np.repeat(self.start[at[hit]], size) + inside]
            wrong = np.bincount(np.repeat(np.arange(len(hit)), size), differs, len(hit))
            hit = hit[wrong == 0]
            texts.append(w.text[hit])
            numbers.append(self.number[at[hit]])
        text, number = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (texts, numbers))
        return text, number


def bags(docs: DataFrame, terms: list[str]) -> DataFrame:
    """One row per document that has a term at all: doc_id, n (terms in the text), and the numbers and counts
    of the terms that are in `terms`, by number."""
    shipped = docs.sparkSession.sparkContext.broadcast(Lexicon(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shipped.value
        for batch in kernel.empty_batches(batches):
            for w in kernel.blocks(batch.column(1), lower=True, separator=kernel.PUNCTUATION):
                n = w.per_text()
                text, number, times = kernel.distinct(*lexicon.find(w))
                cut = pa.array(np.searchsorted(text, np.arange(w.n + 1)).astype(np.int32))
                rows = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(w.first, w.n), pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(cut, pa.array(number.astype(np.int32))),
                    pa.ListArray.from_arrays(cut, pa.array(times.astype(np.int32)))], names=["doc_id", "n", "terms", "tf"])
                yield rows.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>")


class Scorer:
    """Scores of classes for a block of items, and the best `k` classes of each item so far."""

    def __init__(self, items: int, item: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, k: int):
        order = np.argsort(term, kind="stable")
        self.item, self.value, self.items, self.k = item[order], (weight[term] * times)[order], items, k
        self.start = np.searchsorted(term[order], np.arange(len(weight) + 1))
        self.best = np.empty((0, 4), np.int64)  # item, -score, smallest doc_id, class
        self.least = np.ones(items, np.int64)  # a score below this cannot enter

    def add(self, batch: pa.RecordBatch) -> None:
        """Classes of a batch: class_no, m, first, terms, tf."""
        number, m, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        cut = batch.column(3).offsets.to_numpy().astype(np.int64)
        term, tf = (batch.column(i).values.to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 4))
        step = max(1, CELLS // max(self.items, 1))
        for low in range(0, len(number), step):
            high = min(low + step, len(number))
            part = slice(cut[low], cut[high])
            row = np.repeat(np.arange(high - low), np.diff(cut[low:high + 1]))
            count = 1_000_000_000 * tf[part] // (1000 * tf[part] + 8 * np.repeat(m[low:high], np.diff(cut[low:high + 1])))
            score = np.zeros((high - low) * self.items, np.int64)
            # terms that many items hold are taken a stretch at a time
            holders = self.start[term[part] + 1] - self.start[term[part]]
            ends = np.cumsum(holders)
            begin = 0
            while begin < len(row):
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + CELLS, "right")))
                n = holders[begin:end]
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[term[part][begin:end]], n)
                np.add.at(score, np.repeat(row[begin:end], n) * self.items + self.item[at],
                          self.value[at] * np.repeat(count[begin:end], n))
                begin = end
            score = score.reshape(high - low, self.items)
            row, item = np.nonzero(score >= self.least)
            self._keep(np.stack([item, -score[row, item], first[low:high][row], number[low:high][row]], 1))

    def _keep(self, found: np.ndarray) -> None:
        everything = np.concatenate([self.best, found])
        everything = everything[np.lexsort(everything.T[::-1])]
        start = np.searchsorted(everything[:, 0], np.arange(self.items + 1))
        place = np.arange(len(everything)) - start[everything[:, 0]]
        self.best = everything[place < self.k]
        full = np.flatnonzero(np.diff(start) >= self.k)
        self.least[full] = -everything[start[full] + self.k - 1, 1]

    def result(self) -> pa.RecordBatch:
        item, score, first, number = self.best.T.copy()
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (item, -score, first, number)], names=["item", "score", "first", "class_no"])


def classes(bag: DataFrame, documents: int, terms: int) -> DataFrame:
    """Rows of bags with the length factor m and the hash of bag and m."""
    m = F.expr(f"25L + (75L * n * {documents}L) div {max(terms, 1)}L")
    return bag.where(F.size("terms") > 0).withColumn("m", m).withColumn("hash", F.xxhash64("terms", "tf", "m"))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    held = materialize(item_terms(items), "item_terms")
    blocks = max(1, -(-held.count() // POSTINGS))
    found = None
    for block in range(blocks):
        here = held.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "term").toArrow()
        one = _search_block(docs, here, k) if here.num_rows else None
        found = one if found is None else found if one is None else found.unionByName(one)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found


def _search_block(docs: DataFrame, held: pa.Table, k: int) -> DataFrame:
    spark = docs.sparkSession
    terms = sorted(set(held["term"].to_pylist()))
    ids = list(dict.fromkeys(held["item_id"].to_pylist()))
    number_of, place_of = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(ids)}
    item = np.array([place_of[x] for x in held["item_id"].to_pylist()], np.int64)
    term = np.array([number_of[t] for t in held["term"].to_pylist()], np.int64)
    times = held["times"].to_numpy()

    bag = materialize(bags(docs, terms), "bags")
    total = bag.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    weight = np.zeros(len(terms), np.int64)
    holders = bag.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    log = F.log((F.lit(2.0) * total["documents"] + 2) / (F.lit(2.0) * F.col("df") + 1))
    for r in holders.select("term", F.floor(F.lit(1000.0) * log).alias("w")).collect():  # one row per term of the block
        weight[r["term"]] = r["w"]

    rows = classes(bag, total["documents"], total["terms"])
    # rows of one hash are told apart by the whole bag; a class of any size is one row before the shuffle
    group = rows.groupBy("hash", "m", "terms", "tf").agg(F.min(F.coalesce("doc_id", F.lit(_LAST))).alias("first"))
    group = materialize(group.withColumn("class_no", F.monotonically_increasing_id()), "classes")
    query = spark.sparkContext.broadcast((len(ids), item, term, times, weight, k))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*query.value)
        for batch in kernel.empty_batches(batches):
            scorer.add(batch)
        yield scorer.result()

    best = group.select("class_no", "m", "first", "terms", "tf").mapInArrow(score, "item long, score long, first long, class_no long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "first", "class_no")
    best = materialize(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "best")

    # members of the best classes: at most k classes an item
    wanted = group.join(_few(best.select("class_no").distinct()), "class_no").select("class_no", "hash", "m", "terms", "tf")
    wanted = materialize(wanted, "best_classes")
    member = rows.join(_few(wanted), ["hash", "m", "terms", "tf"])
    by_id = Window.partitionBy("class_no").orderBy(F.asc_nulls_last("doc_id"))
    member = member.select("class_no", "doc_id").withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k)
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.join(member, "class_no").withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    names = spark.createDataFrame(pa.table({"item": pa.array(range(len(ids)), pa.int64()), "item_id": pa.array(ids, pa.int64())}))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _few(df: DataFrame) -> DataFrame:
    """The frame with a hint to broadcast it where it has few rows, and to merge otherwise."""
    return F.broadcast(df) if df.limit(FEW_CLASSES + 1).count() <= FEW_CLASSES else df.hint("merge")
