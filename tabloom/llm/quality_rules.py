"""Quality rules: counts that rule a text out, and a hashed n-gram log-likelihood ratio.

Words and word pairs are hashed into `2 ** bits` buckets. One multinomial over the buckets comes from
every document (the raw corpus), one from the trusted documents (the target). A document's score is the
mean over its n-grams of log target share minus log raw share, so long and short texts compare; it is
kept if the score reaches `threshold`. The threshold is a fixed number: the same text against the same
counts always gets the same verdict.

Counts are summed inside a task before the shuffle, at most one row per bucket and task, and the two count
vectors (fixed size) come to the driver. Scoring and rules cover every whole text.

Defined results: a null or empty text has no word, fails the base rule and is not kept; its score is 0.
Repeated rows get equal results; a null id is a value like any other and never trusted. Without trusted
documents every score is 0 and the base rules decide alone. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm import kernel


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    smoothing: float = 0.5
    threshold: float = -0.15
    least_words: int = 50
    most_repeated: int = 50  # per cent of the words


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True  # fixed values: the symbols counted


def _buckets(w: kernel.Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and every pair of words."""
    pair, at = w.grams(2)
    key = np.concatenate([kernel.mix(w.hash ^ np.uint64(0x1234567)), pair])
    return np.concatenate([w.text, w.text[at]]), (key >> np.uint64(64 - bits)).astype(np.int64)


def _counts(docs: DataFrame, s: Settings) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << s.bits, np.int64)
        for batch in kernel.empty_batches(batches):
            for w in kernel.blocks(batch.column(0)):
                total += np.bincount(_buckets(w, s.bits)[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << s.bits)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def ratios(docs: DataFrame, trusted: DataFrame, s: Settings = Settings()) -> np.ndarray:
    """Log ratio of each bucket's share in the trusted documents (ids in `trusted`) and in all documents."""
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    # both sides grow with the data: always a shuffle, never a broadcast that only small tables allow
    target = _counts(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi"), s)
    raw = _counts(docs, s)
    if target.sum() == 0:
        return np.zeros(1 << s.bits, np.float32)
    # the prior of a bucket is its raw share, so a bucket without target counts is not judged by its size
    share = (raw + s.smoothing) / (raw.sum() + s.smoothing * len(raw))
    weight = s.smoothing * len(raw)
    return (np.log((target + weight * share) / (target.sum() + weight)) - np.log(share)).astype(np.float32)


def base_counts(w: kernel.Words) -> dict[str, np.ndarray]:
    """Word characters, symbols, repeated lines and repeated words of each text of a block."""
    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return (total[w.bounds[1:]] - total[w.bounds[:-1]]).astype(np.int64)

    starts_char = (w.data & 0xC0) != 0x80
    return {
        "n_words": w.per_text().astype(np.int64),
        "word_chars": per_text(starts_char & ~w.gap),
        "n_symbols": per_text(_SYMBOL[w.data]),
        "n_dup_lines": _repeated_lines(w),
        "n_repeat_words": _repeated_words(w),
    }


def _repeated_lines(w: kernel.Words) -> np.ndarray:
    if len(w.start) == 0:
        return np.zeros(w.n, np.int64)
    cut = np.flatnonzero(w.data == 10)
    start = np.unique(np.concatenate([w.bounds[:-1], cut + 1]))
    start = start[start < len(w.data)]
    # a line ends before its line feed, or with its text
    after = np.minimum(np.append(start[1:], len(w.data)), len(w.data))
    text = np.searchsorted(w.bounds, start, "right") - 1
    end = after - (w.data[after - 1] == 10)
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    full = words > 0
    text, h = text[full], w.segment(start[full], end[full])
    t, _, _ = kernel.distinct(text, h)
    return np.bincount(text, minlength=w.n) - np.bincount(t, minlength=w.n)


def _repeated_words(w: kernel.Words) -> np.ndarray:
    h, at = w.grams(3)
    if len(h) == 0:
        return np.zeros(w.n, np.int64)
    order = np.lexsort((h, w.text[at]))
    hs, ts = h[order], w.text[at][order]
    same = (hs[1:] == hs[:-1]) & (ts[1:] == ts[:-1])
    again = np.zeros(len(h), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = at[order[again]]
    covered = np.zeros(len(w.hash), bool)
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(w.text[covered], minlength=w.n)


def judge(docs: DataFrame, trusted: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of `docs`: doc_id, the base counts, base_failed, score and kept."""
    ratio = ratios(docs, trusted, s)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            for w in kernel.blocks(batch.column(1)):
                base = base_counts(w)
                text, bucket = _buckets(w, s.bits)
                count = np.bincount(text, minlength=w.n)
                score = np.bincount(text, ratio[bucket], w.n) / np.maximum(count, 1)
                n = base["n_words"]
                failed = (n < s.least_words) | (100 * base["n_repeat_words"] > s.most_repeated * n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.first, w.n), *[pa.array(base[k].astype(np.int64)) for k in names],
                     pa.array(failed), pa.array(score), pa.array(~failed & (score >= s.threshold))],
                    names=["doc_id", *names, "base_failed", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, score double, kept boolean")
