"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by class log-count ratios.

Features of a text are the distinct hashed words, word pairs and word endings it holds (an indicator
each, in `2 ** bits` buckets). Class log-count ratios scale the indicators, dual coordinate descent fits
the hinge loss, and a logistic curve fitted on rows kept out of the fit turns margins into scores.

The model is fitted in one task on a bounded sample of labelled rows: at most `sample` rows, those with
the smallest hash of the id, whose texts have at most `sample_bytes` bytes. Scoring covers every whole
text. Labels, language, source and id are no inputs of a score.

Defined results: a null text scores as an empty one; an empty text gets the score of the bias alone; a
text with no known feature likewise; rows with a null id are scored and count as not held out; repeated
rows get equal scores; with no usable label, or labels of one class only, every score is the share of
label 1 (0.5 without labels). Extra columns are ignored unless named in `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import kernel


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    sample: int = 12_000
    sample_bytes: int = 100_000
    epochs: int = 15
    cost: float = 1.0
    smoothing: float = 1.0
    calibration: int = 4  # every so many rows of the sample are kept for the score curve
    threshold: float = 0.7
    seed: int = 7


def features(column: pa.Array, bits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per block: first text, number of texts, and the distinct (text, bucket) pairs in order."""
    shift = np.uint64(64 - bits)
    for w in kernel.blocks(column):
        pair, at = w.grams(2)
        same = w.hash[at] == w.hash[at + 1] if len(at) else np.empty(0, bool)
        pair[same] = np.uint64(0xA5A5A5A5A5A5A5A5)  # one feature for "a word and the same again"
        key = [w.hash, pair, _endings(w)]
        text = np.concatenate([w.text, w.text[at], w.text])
        bucket = (np.concatenate([kernel.mix(k + np.uint64(i)) for i, k in enumerate(key)]) >> shift).astype(np.int64)
        code = np.unique((text << np.int64(bits)) | bucket)
        yield w.first, w.n, code >> np.int64(bits), code & np.int64((1 << bits) - 1)


def _endings(w: kernel.Words) -> np.ndarray:
    """The last three bytes of each word, fewer for a shorter one."""
    code = np.zeros(len(w.end), np.uint64)
    for k in range(1, 4):
        at = w.end - k
        code = code * np.uint64(257) + np.where(at >= w.start, w.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return code


@dataclass
class Model:
    """`weight` is the fitted weight times the ratio per bucket; `ratio` gives the length of a row."""

    weight: np.ndarray
    ratio: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int

    def scores(self, column: pa.Array) -> np.ndarray:
        margin = np.zeros(len(column))
        for first, n, text, bucket in features(column, self.bits):
            dot = np.bincount(text, self.weight[bucket], n)
            size = np.bincount(text, self.ratio[bucket] ** 2, n)
            margin[first:first + n] = dot / np.sqrt(size + 1.0) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def fit_rows(rows: list[np.ndarray], label: np.ndarray, s: Settings) -> Model:
    """Fit on the feature buckets of each row."""
    size = 1 << s.bits
    share = float(label.mean()) if len(label) else 0.5
    kept_out = np.arange(len(rows)) % s.calibration == 0
    train = np.flatnonzero(~kept_out)
    if len(train) == 0 or len(np.unique(label[train])) < 2:
        logit = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), logit, 1.0, 0.0, s.bits)
    count = np.full((2, size), s.smoothing)
    for i in train:
        count[label[i], rows[i]] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    ratio[count.sum(0) <= 2 * s.smoothing] = 0.0
    learned = [rows[i] for i in train]
    weight, bias = _descend(_Values(ratio, learned), learned, np.where(label[train] == 1, 1.0, -1.0), size, s)
    scaled = weight * ratio
    margin = np.array([scaled[rows[i]].sum() / np.sqrt((ratio[rows[i]] ** 2).sum() + 1.0) + bias
                       for i in np.flatnonzero(kept_out)])
    slope, offset = _curve(margin, label[kept_out])
    return Model(scaled.astype(np.float32), ratio.astype(np.float32), bias, slope, offset, s.bits)


class _Values(Sequence):
    """The values of each row's features, looked up when asked for, so that none are held."""

    def __init__(self, ratio: np.ndarray, rows: list[np.ndarray]):
        self.ratio, self.rows = ratio, rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ratio[self.rows[i]]


def _descend(values, buckets, sign, size: int, s: Settings) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; rows are scaled to about unit length, the bias is a
    feature that is always 1."""
    weight, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(values))
    norm = [np.sqrt((v * v).sum() + 1.0) for v in values]
    curvature = [((v / n) ** 2).sum() + 1.0 for v, n in zip(values, norm)]
    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        moved = 0.0
        for i in order.permutation(len(values)):
            x, at = values[i] / norm[i], buckets[i]
            gradient = sign[i] * (weight[at] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / curvature[i], 0.0), s.cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                weight[at] += step * x
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weight, bias


def _curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on smoothed targets."""
    if len(margin) == 0:
        return 1.0, 0.0
    ones = int(label.sum())
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at[0] * margin + at[1], -30, 30)))
        grad = np.array([((p - target) * margin).sum() + 1e-3 * (at[0] - 1), (p - target).sum()])
        q = p * (1 - p) + 1e-9
        hess = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum()]])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        at -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def held_out(key: str = "doc_id"):
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Only the ids of the sample (at most `settings.sample`) and the fitted weights pass through the
    driver; the texts go to the one task that fits.
    """
    marked = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    ids = marked.withColumn("_order", F.xxhash64(F.col("doc_id"))) \
        .orderBy("_order", "doc_id").limit(settings.sample).collect()
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(r["doc_id"], r["_label"], i) for i, r in enumerate(ids)],
                                   "_id long, _label int, _order int")
    texts = docs.select(F.col("doc_id").alias("_id"), "text") \
        .join(F.broadcast(chosen), "_id").where(F.octet_length("text") <= settings.sample_bytes) \
        .withColumn("_copy", F.row_number().over(_first_copy())).where("_copy = 1") \
        .select("_order", "_label", "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, label_of, parts, sizes = [], [], [], []
        for batch in kernel.empty_batches(batches):
            order += batch.column(0).to_pylist()
            label_of += batch.column(1).to_pylist()
            for _, n, text, bucket in features(batch.column(2), settings.bits):
                parts.append(bucket.astype(np.int32))
                sizes.append(np.bincount(text, minlength=n))
        by = np.argsort(np.array(order, np.int64), kind="stable")
        flat = np.concatenate([*parts, np.empty(0, np.int32)])
        parts.clear()
        cut = np.concatenate([[0], *sizes]).cumsum()
        model = fit_rows([flat[cut[i]:cut[i + 1]] for i in by], np.array(label_of, np.int64)[by], settings)
        flat = None  # the worker goes on to score
        yield pa.RecordBatch.from_pydict({
            "weight": [model.weight.tobytes()], "ratio": [model.ratio.tobytes()], "bias": [model.bias],
            "slope": [model.slope], "offset": [model.offset],
        })

    row = texts.coalesce(1).mapInArrow(
        train, "weight binary, ratio binary, bias double, slope double, offset double").collect()
    if not row:
        return fit_rows([], np.empty(0, np.int64), settings)
    r = row[0]
    return Model(np.frombuffer(r["weight"], np.float32), np.frombuffer(r["ratio"], np.float32),
                 r["bias"], r["slope"], r["offset"], settings.bits)


def _first_copy():
    from pyspark.sql import Window

    return Window.partitionBy("_id").orderBy(F.xxhash64("text"), "text")


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = Settings().threshold) -> DataFrame:
    """Columns `keep` of every row, its score and whether it reaches the threshold."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    names = [*keep, "score", "predicted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            s = model.scores(batch.column(len(keep)))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=names)

    return docs.select(*keep, F.col("text").alias("_scored_text")).mapInArrow(
        run, f"{fields}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Score of every document, with the rows that no label was learned from marked."""
    model = fit(docs, labels, settings=settings)
    return score(docs, model, ["doc_id"], settings.threshold).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of `docs` that the classifier accepts, with their columns."""
    model = fit(docs, labels, settings=settings)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            yield batch.filter(pa.array(model.scores(batch.column(at)) >= settings.threshold))

    return docs.mapInArrow(run, docs.schema)
