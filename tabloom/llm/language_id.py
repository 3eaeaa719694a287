"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per page:

- text: naive Bayes over hashed words and byte trigrams of the page's text, trained on the labelled
  documents; the likelihood is tempered to `text_weight` per n-gram up to `text_most` n-grams, as n-grams
  of one text are far from independent;
- the language that the markup declares, by how often each declared value goes with each language;
- the address suffix, likewise;
- the host's language mix, smoothed towards its domain's mix, that towards the overall mix. A page's own
  text is taken out of the host's counts first, so it isn't counted twice.

Declared values, suffixes, hosts and domains are counted by grouped aggregation of the text posteriors
over all pages; only the language model (languages times buckets) comes to the driver. Host statistics are
looked up with salted keys, so a host with a third of all pages is no single task.

Defined results: a null or empty page has no text evidence and is judged by the rest; a null url has the
host and suffix ''; repeated rows all count; with no labelled document the language is null; equal
posteriors go to the first language in code-point order. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm import kernel
from tabloom.llm.common import salted_lookup
from tabloom.storage import materialize


@dataclass(frozen=True)
class Settings:
    bits: int = 15  # buckets of words, and as many of trigrams
    smoothing: float = 0.5
    text_weight: float = 0.05
    text_most: int = 400
    host_strength: float = 4.0  # pages that a prior counts for
    evidence_smoothing: float = 2.0


def _buckets(w: kernel.Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every word and of every byte trigram that lies in one text."""
    word = (kernel.mix(w.hash) >> np.uint64(64 - bits)).astype(np.int64)
    if len(w.data) < 3:
        return w.text, word
    d = w.data.astype(np.uint64)
    code = d[:-2] | (d[1:-1] << np.uint64(8)) | (d[2:] << np.uint64(16))
    owner = np.repeat(np.arange(w.n), np.diff(w.bounds))
    inside = owner[2:] == owner[:-2]
    tri = (kernel.mix(code[inside]) >> np.uint64(64 - bits)).astype(np.int64) + (1 << bits)
    return np.concatenate([w.text, owner[:-2][inside]]), np.concatenate([word, tri])


@dataclass
class Model:
    languages: list[str]
    log_share: np.ndarray  # languages x buckets


def train(docs: DataFrame, s: Settings = Settings()) -> Model:
    """Count n-grams per language over all labelled documents; a task sends one row per language and
    bucket at most."""
    width = 2 << s.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in kernel.empty_batches(batches):
            lang = batch.column(1).to_pylist()
            names = sorted(set(lang))
            code = np.array([names.index(x) for x in lang])
            for w in kernel.blocks(batch.column(0)):
                text, bucket = _buckets(w, s.bits)
                n = np.bincount(code[w.first:w.first + w.n][text] * width + bucket, minlength=width * len(names))
                for i, x in enumerate(names):
                    total[x] = total.get(x, 0) + n[i * width:(i + 1) * width]
        for x, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at), pa.string()), pa.array(at), pa.array(n[at])],
                                             names=["lang", "bucket", "n"])

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang") \
        .mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang = rows["lang"].to_numpy(zero_copy_only=False)
    names = sorted(set(lang))
    count = np.full((len(names), width), s.smoothing)
    for i, x in enumerate(names):
        own = lang == x
        count[i, rows["bucket"].to_numpy()[own]] += rows["n"].to_numpy()[own]
    for half in (slice(0, 1 << s.bits), slice(1 << s.bits, width)):
        count[:, half] /= count[:, half].sum(1, keepdims=True)
    return Model(names, np.log(count).astype(np.float32))


#: What a page does not show.
HIDDEN = "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>"


def _page_parts(pages: DataFrame, languages: list[str]) -> DataFrame:
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    declared = F.lower(F.regexp_extract(html, "(?i)<html\\b[^>]*?\\slang\\s*=\\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        "page_id", host.alias("host"), F.array_join(F.slice(F.split(host, "\\."), F.greatest(-F.size(F.split(host, "\\.")), F.lit(-2)), 2), ".").alias("domain"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.when(declared.isin(languages), declared).when(declared == "", "none").otherwise("other").alias("declared"),
        F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), "&[A-Za-z#0-9]+;", " ").alias("text"))


def _text_evidence(parts: DataFrame, model: Model, s: Settings) -> DataFrame:
    """The tempered log-likelihood of every language, and its posterior under equal priors."""
    k = len(model.languages)
    names = ["page_id", "host", "domain", "suffix", "declared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernel.empty_batches(batches):
            for w in kernel.blocks(batch.column(5)):
                text, bucket = _buckets(w, s.bits)
                n = np.bincount(text, minlength=w.n)
                mean = np.stack([np.bincount(text, model.log_share[i][bucket], w.n) for i in range(k)], 1) / np.maximum(n, 1)[:, None]
                log = mean * (s.text_weight * np.minimum(n, s.text_most))[:, None]
                log -= log.max(1, keepdims=True)
                p = np.exp(log) / np.exp(log).sum(1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(w.first, w.n) for i in range(5)]
                    + [pa.array(list(log), pa.list_(pa.float64())), pa.array(list(p), pa.list_(pa.float64()))],
                    names=[*names, "log", "p"])

    return parts.mapInArrow(run, "page_id long, host string, domain string, suffix string, declared string, log array<double>, p array<double>")


def _sums(rows: DataFrame, key: str, k: int, column: str = "p") -> DataFrame:
    total = rows.groupBy(key).agg(*[F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(k)])
    return total.select(key, F.array(*[f"s{i}" for i in range(k)]).alias(column))


def _likelihood(counts: DataFrame, key: str, total: list[float], s: Settings, name: str) -> DataFrame:
    """log P(value | language) of a value that goes with languages as often as `counts` says, drawn to the
    value's share over all languages."""
    everything = sum(total)
    value = F.aggregate("p", F.lit(0.0), lambda a, v: a + v) / everything
    per = [F.log((F.col("p")[i] + s.evidence_smoothing * value) / (total[i] + s.evidence_smoothing)) for i in range(len(total))]
    return counts.select(key, F.array(*per).alias(name))


def identify(pages: DataFrame, docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of `pages`: page_id, host, suffix, declared, text_language, language, posterior."""
    model = train(docs, s)
    k = len(model.languages)
    if k == 0:
        parts = _page_parts(pages, [])
        return parts.select("page_id", "host", "suffix", "declared", F.lit(None).cast("string").alias("text_language"),
                            F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior"))
    rows = materialize(_text_evidence(_page_parts(pages, model.languages), model, s), "page_evidence")

    by_host = materialize(rows.groupBy("host", "domain", "suffix").agg(*[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)])
                          .select("host", "domain", "suffix", F.array(*[f"s{i}" for i in range(k)]).alias("p")), "hosts")
    by_declared = materialize(_sums(rows, "declared", k), "declared")  # at most languages + 2 rows
    found = by_declared.collect()
    total = [sum(r["p"][i] for r in found) + 1.0 for i in range(k)]
    overall = [t / sum(total) for t in total]

    def mixed(counts: Column, prior: Column | list[float]) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, v: a + v)
        return F.array(*[(counts[i] + s.host_strength * (prior[i] if isinstance(prior, list) else prior[i])) / (n + s.host_strength) for i in range(k)])

    domains = _sums(by_host, "domain", k).select(F.col("domain").alias("_domain"), mixed(F.col("p"), overall).alias("of_domain"))
    suffixes = _likelihood(_sums(by_host, "suffix", k), "suffix", total, s, "of_suffix").withColumnRenamed("suffix", "_suffix")
    hosts = by_host.join(domains, F.col("domain") == F.col("_domain")).join(suffixes, F.col("suffix") == F.col("_suffix")) \
        .select("host", F.col("p").alias("of_host"), "of_domain", "of_suffix")
    declared = F.create_map(*[x for r in found for x in (F.lit(r["declared"]), F.array(*[F.lit(
        float(np.log((r["p"][i] + s.evidence_smoothing * sum(r["p"]) / sum(total)) / (total[i] + s.evidence_smoothing)))) for i in range(k)]))]) \
        if found else F.create_map().cast("map<string,array<double>>")

    joined = salted_lookup(rows, hosts, "host", F.col("page_id"))
    others = F.array(*[F.greatest(F.col("of_host")[i] - F.col("p")[i], F.lit(0.0)) for i in range(k)])
    joined = joined.withColumn("prior", mixed(others, F.col("of_domain"))).withColumn("of_declared", declared[F.col("declared")])
    log = F.array(*[F.col("log")[i] + F.col("of_declared")[i] + F.col("of_suffix")[i] + F.log(F.col("prior")[i]) for i in range(k)])
    names = F.array(*[F.lit(x) for x in model.languages])
    scored = joined.withColumn("score", F.transform(log, lambda v: F.round(v, 9)))
    best = F.array_max("score")
    share = 1.0 / F.aggregate("score", F.lit(0.0), lambda a, v: a + F.exp(v - best))
    return scored.select(
        "page_id", "host", "suffix", "declared",
        names[(F.array_position("p", F.array_max("p")) - 1).cast("int")].alias("text_language"),
        names[(F.array_position("score", best) - 1).cast("int")].alias("language"), F.round(share, 6).alias("posterior"))
