import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tabloom.llm import quality_classifier as qc
from tabloom.llm import quality_rules as qr
from tests_llm_rows import rows_of

SF = "/root/testdata/sf0.1"


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against long projected-gradient steps on the same dual problem."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(40, 6))
    sign = np.where(x @ draw.normal(size=6) + 0.3 * draw.normal(size=40) > 0, 1.0, -1.0)
    at = [np.arange(6)] * 40
    w, b = qc._descend(list(x), at, sign, 6, qc.Settings(epochs=3000))
    z = np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True) + 1), np.ones((40, 1))]) * sign[:, None]
    alpha = np.zeros(40)
    for _ in range(40_000):
        alpha = np.clip(alpha - 0.01 * (z @ (z.T @ alpha) - 1), 0, 1)
    assert np.allclose(np.append(w, b), z.T @ alpha, atol=0.02)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = qc.classify(docs, labels)
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert len(rows) > 500
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert (good.score.values[:, None] > bad.score.values[None, :]).mean() > 0.97
    assert (good.predicted == 1).mean() > 0.96 and (bad.predicted == 0).mean() > 0.85


def test_held_out_rows_teach_nothing(spark):
    """Labels of held-out rows may say anything."""
    docs, labels = (spark.read.parquet(f"{SF.replace('0.1', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.withColumn("quality", F.when(qc.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    got = qc.classify(docs, labels)
    assert rows_of(got, "doc_id", "score") == rows_of(qc.classify(docs, wrong), "doc_id", "score")
    assert {r["doc_id"] for r in got.where("held_out").collect()} == {i for i in ids if zlib.crc32(str(i).encode()) % 4 == 2}


def test_classifier_edges(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (6, 0, 0), (7, 1, 0), (None, 1, 1), (8, None, 1), (9, 0, 1)], "doc_id long, quality int, score int")
    got = qc.classify(docs, labels)
    assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert got.where("doc_id IN (3, 4, 5)").select("score").distinct().count() == 1
    kept = qc.keep_good(docs, labels)
    assert kept.schema == docs.schema
    none = labels.where("false")
    assert qc.classify(docs, none).select("score").distinct().collect()[0][0] == 0.5
    assert qc.classify(no_docs, labels).collect() == [] and qc.keep_good(no_docs, labels).collect() == []


def brute_scores(texts, trusted, s):
    """Counts in dictionaries, from the same hashed n-grams."""
    from collections import Counter

    from tabloom.llm import kernel

    grams = [Counter(b for w in kernel.blocks(pa.array([t])) for b in qr._buckets(w, s.bits)[1].tolist()) for t in texts]
    raw, target = Counter(), Counter()
    for g, good in zip(grams, trusted):
        raw.update(g)
        target.update(g if good else {})
    width, r, t = 1 << s.bits, sum(raw.values()), sum(target.values())
    out = []
    for g in grams:
        total = 0.0
        for b, n in g.items():
            share = (raw[b] + s.smoothing) / (r + s.smoothing * width)
            total += n * (np.log((target[b] + s.smoothing * width * share) / (t + s.smoothing * width)) - np.log(share))
        out.append(total / max(sum(g.values()), 1))
    return out


def test_ratio_equals_brute_force(spark):
    texts = ["good prose about rivers and hills " * 9, "bad*** words### here!!! " * 20, "", None, "good rivers here", "x " * 500, "good prose " + "y" * 50_000]
    s = qr.Settings(bits=8)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trusted = spark.createDataFrame([(0,), (4,), (4,), (None,), (99,)], "doc_id long")
    got = [r["score"] for r in qr.judge(df, trusted, s).orderBy("doc_id").collect()]
    assert np.allclose(got, brute_scores(texts, [i in (0, 4) for i in range(7)], s), atol=1e-5)


def test_rules_edges(spark, docs, no_docs):
    trusted = spark.createDataFrame([(1,), (8,)], "doc_id long")
    got = qr.judge(docs, trusted)
    assert got.count() == docs.count()
    assert got.where("doc_id IN (3, 4, 5, 6)").where("NOT base_failed OR kept").count() == 0
    assert qr.judge(no_docs, trusted).collect() == []
    assert {r["score"] for r in qr.judge(docs, trusted.where("false")).collect()} == {0.0}
