import corpus_pipeline as cp
from tabloom.llm import decontaminate, mixing, near_dedup, quality_classifier, secrets

SF = "/root/testdata/sf0.001"


def test_stages_in_order_equal_the_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        path = cp.materialize(out, "test-" + name)
        if name != cp.STAGES[-1][0]:
            assert path.columns == columns
        docs = path
        seen.append(docs.count())
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "mix"]
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] == seen[4] == seen[5] > 0, seen
    assert seen[0] > seen[3], seen
    again = cp.run(spark, SF)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_each_stage_does_what_its_operator_says(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    scored = quality_classifier.classify(docs, labels)
    assert ids(cp.good_quality(spark, docs, SF)) == ids(scored.where("predicted = 1"))
    assert ids(cp.near_deduplicated(spark, docs, SF)) == ids(near_dedup.near_duplicates(docs, 5, 80).where("kept"))
    assert ids(cp.decontaminated(spark, docs, SF)) == ids(decontaminate.report(docs, bench).where("NOT contaminated"))
    changed = cp.without_secrets(spark, docs, SF).join(docs.selectExpr("doc_id", "text AS old"), "doc_id").where("text <> old")
    assert ids(changed) == ids(secrets.report(docs).where("spans <> ''"))
    assert mixing.taken(docs).count() == docs.count()


def test_run_equals_a_replay_without_spark(spark, tmp_path):
    """Documents, a benchmark and labels of our own: the stages are replayed by the plain versions of the other
    tests. All labels are good, so the first stage keeps every document; the mix is held to its targets."""
    import random

    import test_decontaminate
    import test_mixing
    import test_near_dedup
    import test_secrets

    draw = random.Random(11)
    items = [(1, "Natalia sold 48 clips in April and then Natalia sold half as many clips in May to a friend"),
             (2, "the old bridge over the river carries nine trains and two trams on every day of the week")]
    rows = []
    for i in range(60):
        words = [draw.choice("stone tree house wind green paper little water line moon road candle".split()) + str(draw.randint(0, 40)) for _ in range(40)]
        text = " ".join(words)
        if i % 7 == 3:
            text += " " + items[i % 2][1].replace("Natalia", "Ina").replace("48", "31")
        if i % 5 == 1:
            text += " password = abcdefgh" + "xyz"[i % 3]
        rows.append((i, text, "en", ["a", "b", None][i % 3], len(text)))
        if i % 6 == 0:
            rows.append((100 + i, text + " end", "en", "c", len(text)))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    tables = {"documents": spark.createDataFrame(rows, schema), "benchmark": spark.createDataFrame(items, "item_id long, text string"),
              "labels": spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    kept = [r for r in test_near_dedup.brute([(i, t) for i, t, *_ in rows], 5, 80) if r[3]]
    ids = sorted(r[0] for r in kept)
    by_id = {r[0]: r for r in rows}
    leaks = test_decontaminate.brute([by_id[i][1] for i in ids], items)
    clean = [i for at, i in enumerate(ids) if not leaks[at][0]]
    assert len(rows) > len(ids) > len(clean) > 30

    def redacted(text):
        out, at = "", 0
        for start, _, end, kind in test_secrets.base(text):
            out, at = out + text[at:start] + f"<{kind}>", end
        return out + text[at:]

    size = {i: len(redacted(by_id[i][1]).split()) for i in clean}
    assert any("<assign>" in redacted(by_id[i][1]) for i in clean)
    got = {r["doc_id"]: r for r in cp.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == clean and {i: r["size"] for i, r in got.items()} == size
    sources = sorted({by_id[i][3] for i in clean}, key=lambda s: (s is None, s))
    total = [sum(size[i] for i in clean if by_id[i][3] == s) for s in sources]
    for s, n, target in zip(sources, total, test_mixing.reshared(total, [1 + k % 3 for k in range(len(sources))])):
        of = [r for i, r in got.items() if by_id[i][3] == s]
        assert all(r["source_size"] == n and abs(r["target"] - target) < 1e-6 and r["taken"] <= 3 * r["size"] for r in of)
        assert abs(sum(r["taken"] for r in of) - target) <= 64
