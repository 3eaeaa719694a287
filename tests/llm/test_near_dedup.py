import random
import re

import numpy as np
import pytest

from tabloom.llm import common, near_dedup as nd
from tests_llm_rows import rows_of


def brute(rows, size, percent):
    """Sets of word runs, all pairs, then a union of the links."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(rows[a][0]), find(rows[b][0])
                top[max(x, y)] = min(x, y)
    return sorted(((i, len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets)), key=repr)


def corpus(seed, families=8, copies=14):
    draw = random.Random(seed)

    def word():
        return "".join(draw.choice("abcdeABCé") for _ in range(4))

    rows = []
    for f in range(families):
        base = [word() for _ in range(draw.choice([2, 3, 7, 12, 60, 200]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 3, 8])):
                w[draw.randrange(len(w))] = word()
            rows.append(" ".join(w).upper() if draw.random() < 0.1 and "é" not in " ".join(w) else " ".join(w))
    rows += [None, "", " \n", "one", "one", "ONE", "one two", "one two", "x" * 200_000, " ".join(["again"] * 50_000)]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, size, percent, band, family", [(1, 3, 85, 1024, 100_000), (2, 5, 80, 1024, 100_000), (3, 3, 85, 3, 40), (4, 3, 60, 1024, 100_000)])
def test_equals_all_pairs(spark, monkeypatch, seed, size, percent, band, family):
    monkeypatch.setattr(nd, "BAND_BLOCK", band)  # small blocks: groups are cut and met pair by pair
    monkeypatch.setattr(nd, "FAMILY_BLOCK", family)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = rows_of(nd.near_duplicates(df, size, percent), "doc_id", "n_shingles", "component_id", "kept")
    assert got == brute(rows, size, percent)


def test_estimate_is_corrected_for_collisions():
    draw = np.random.default_rng(4)
    for share in (0.0, 0.5, 0.85):
        n, found = 3000, []
        for _ in range(20):
            both = draw.integers(0, 2**63, int(n * 2 * share / (1 + share)), dtype=np.uint64)
            sets = [np.concatenate([both, draw.integers(0, 2**63, n - len(both), dtype=np.uint64)]) for _ in range(2)]
            regs = [nd.registers(1, np.zeros(n, np.int64), s)[0] for s in sets]
            chance = nd.chances(np.array([n]))[0]
            found.append(nd.estimate((regs[0] == regs[1]).sum(), chance @ chance))
        assert abs(np.mean(found) - share) < 0.03, share


def test_components(spark):
    draw = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(120)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    assert got == {k: v for k, v in top.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_edges(docs, no_docs):
    got = {r["doc_id"]: r for r in nd.near_duplicates(docs).collect()}
    assert nd.near_duplicates(docs).count() == docs.count() and nd.near_duplicates(no_docs).collect() == []
    assert got[1]["component_id"] == got[2]["component_id"] == 1 and got[3]["n_shingles"] == 0 and got[3]["kept"]
    assert got[6]["n_shingles"] == 1 and got[5]["component_id"] == 5
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text") == sorted({(r["doc_id"], r["text"]) for r in docs.collect()
                                                      if r["doc_id"] != 2 and (r["doc_id"] is not None or r["text"] is None)}, key=repr)


def test_a_large_family_of_short_copies_is_cut_by_documents(spark):
    n = 30_000
    notice = " ".join(f"w{k}" for k in range(12))
    docs = spark.range(n).selectExpr("id AS doc_id", f"concat('{notice} own', id) AS text")
    members = docs.selectExpr("doc_id AS node", "9L AS n", "0L AS component")
    blocks = nd._family_blocks(members).first()["blocks"]
    assert blocks == n / nd.FAMILY_DOCS
    families = members.selectExpr("node", "component AS family", f"{blocks}L AS blocks")
    edges = nd._verified_forest(docs, families, 5, 80).toPandas()
    top = np.arange(n)

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for a, b in zip(edges["a"], edges["b"]):
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    assert {find(i) for i in range(n)} == {0} and len(edges) < blocks * 2 * n


def test_bands_follow_from_the_similarity():
    for percent in (60, 80, 85, 95, 100):
        rows, bands = nd.bands_for(percent)
        assert rows * bands <= nd.BUCKETS and (1 - (percent / 100) ** rows) ** bands <= nd.MISS * 1.001
    assert nd.bands_for(85) == (6, 36)
    with pytest.raises(ValueError):
        nd.bands_for(3)


def test_rounds_of_components_grow_with_the_logarithm(spark, monkeypatch):
    seen = []

    def counted(df, label="table"):
        seen.append(label)
        return common_materialize(df, label)

    common_materialize = common.materialize
    monkeypatch.setattr(common, "materialize", counted)
    for path in ([(i, i + 1) for i in range(1000)], [(1000 - i, 999 - i) for i in range(1000)]):
        seen.clear()
        got = common.components(spark.createDataFrame(path, "a long, b long"))
        assert got.count() == 1001 and got.where("component <> 0").count() == 0
        assert seen.count("hooks") + seen.count("jumps") <= 14


def test_one_row_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(4, long + " x", 0), (4, "quite another text of several words here", 1), (7, long + " y", 2), (None, long + " y", 3),
            (None, "no id and no copy with an id at all", 4), (None, "no id and no copy with an id at all", 5), (9, long, 6), (None, "", 7), (None, "", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = nd.keep_one(df, 5, 80)
    got = sorted(r["row"] for r in kept.collect())
    assert len(got) == 4 and len({0, 1} & set(got)) == 1 and len({4, 5} & set(got)) == 1 and {7, 8} <= set(got)
