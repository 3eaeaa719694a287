from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tabloom.llm import mixing as m
from tests_llm_rows import rows_of


def reshared(sizes, weights, most=3):
    """Limits applied one after the other, the excess reshared by weight until none is above."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        open_weight = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [Fraction(most * sizes[i]) if i in capped else Fraction(left * weights[i], open_weight) for i in range(len(sizes))]
        above = {i for i in range(len(sizes)) if target[i] > most * sizes[i]}
        if not above:
            return [float(t) for t in target]
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 0, 100, 5, 2, 900], [1000, 1, 1, 1], [7], [0, 0, 3], [5, 50, 500, 5000, 1, 1, 20_000]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, size long")
    got = [r["target"] for r in m.targets(df).orderBy("rank").collect()]
    assert np.allclose(got, reshared(sizes, [1 + i % 3 for i in range(len(sizes))]))


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in (1, 2):
            out = m.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
            assert sorted(out.tolist()) == list(range(n))


def test_mix_of_whole_documents(spark):
    draw = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(draw.integers(0, 900))), ["a", "b", "c", None, "big"][int(draw.choice(5, p=[.1, .1, .1, .1, .6]))]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = m.taken(df).toPandas()
    assert len(got) == 400 and (got["size"] == got.doc_id.map({i: len(t.split()) for i, t, _ in rows})).all()
    assert (got.taken <= 3 * got["size"]).all()
    for _, g in got.groupby(got.source.fillna("~")):
        assert g["size"].sum() == g.source_size.iloc[0] and abs(g.taken.sum() - g.target.iloc[0]) <= 64
    assert rows_of(m.taken(df.repartition(7)), "doc_id", "taken") == rows_of(m.taken(df), "doc_id", "taken")


def test_taken_words_are_those_of_the_mix(spark):
    """The per-document sums against the blocks of the mix itself, with several shards."""
    rows = [(i, " ".join(["w"] * (7 * i % 90)), "ab"[i % 2] if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    s = m.Settings(block=5, shard=40)
    sums, last = defaultdict(int), -1
    mix = m.mixture(df, s).collect()
    for r in mix:
        assert sum(p["words"] for p in r["pieces"]) <= 5
        for p in r["pieces"]:
            sums[p["doc_id"]] += p["words"]
        last = max(last, r["shard"])
    assert last > 3 and all(sum(r["shard"] == k for r in mix) == 40 for k in range(last))
    assert {r["doc_id"]: r["taken"] for r in m.taken(df, s).collect() if r["taken"]} == dict(sums)


def test_edges(docs, no_docs):
    got = m.taken(docs)
    assert got.count() == docs.count() and got.where("size = 0 AND taken > 0").count() == 0
    assert m.taken(no_docs).collect() == []


def test_a_small_table_has_many_drawn_shards(spark):
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(draw.integers(1, 200))), "abc"[int(draw.choice(3, p=[.2, .3, .5]))]) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    _, sources = m.place(df)
    drawn = m._draws(sources, m.Settings()).toPandas()
    shares = drawn.pivot(index="shard", columns="rank", values="count").fillna(0).to_numpy()
    assert len(shares) >= 60 and len(set(shares.sum(1)[:-1])) == 1
    expected = shares.sum(0) / shares.sum()
    n = shares.sum(1)[0]
    spread = ((shares[:-1] - n * expected) ** 2 / (n * expected)).sum() / (2 * (len(shares) - 1))
    assert 0.5 < spread < 2  # the shards differ as multinomial counts do
    assert (drawn.sort_values(["rank", "shard"]).groupby("rank")["count"].cumsum() - drawn["count"] == drawn["first"]).all()


def test_a_shard_is_drawn_by_itself():
    owed = np.array([1000, 0, 3, 70_000, 12_345])
    every = list(m._shards(owed, 100, 5, 0, 10**9))
    assert [e[0] for e in every] == list(range(len(every))) and sum(e[2] for e in every).tolist() == owed.tolist()
    for low in (0, 7, 500, len(every) - 1):
        shard, first, count = next(m._shards(owed, 100, 5, low, low + 1))
        assert shard == low and (first == every[low][1]).all() and (count == every[low][2]).all()
