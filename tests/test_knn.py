"""The block join against brute force, with and without pruning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import knn, lof
from tabloom.operators.impute import MissingValues
from tabloom.operators.outliers import Outliers


def table(spark, n=400, p=3, seed=3, gaps=0.15, groups=("a", "b"), rare=(), quarters=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    if quarters:  # exact distances, so that ties are ties
        x = np.round(x * 4) / 4
    x[rng.random((n, p)) < gaps] = np.nan
    g = [str(rng.choice(groups)) if i not in rare else "tiny" for i in range(n)]
    rows = [(i, g[i], *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    cols = [f"c{j}" for j in range(p)]
    df = spark.createDataFrame(rows, "car_id long, brand string, " + ", ".join(f"{c} double" for c in cols))
    return df, x, np.array(g), cols


def brute_fill(x, donors, k, fallback):
    out = x.copy()
    p = x.shape[1]
    for i in range(len(x)):
        for t in np.flatnonzero(np.isnan(x[i])):
            best = []
            for j in range(len(donors)):
                both = ~np.isnan(x[i]) & ~np.isnan(donors[j])
                if np.isnan(donors[j, t]) or not both.any():
                    continue
                best.append((p / both.sum() * ((x[i] - donors[j])[both] ** 2).sum(), j))
            best.sort()
            chosen = [donors[j, t] for _, j in best[:k]]
            out[i, t] = np.mean(chosen) if chosen else fallback[t]
    return out


def collected(df, cols):
    rows = sorted(df.collect(), key=lambda r: r["car_id"])
    return np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in rows])


@pytest.mark.parametrize("top, share", [(10**6, 128), (2, 3)])
def test_whole_table_imputer(spark, monkeypatch, top, share):
    monkeypatch.setattr(knn, "TOP_NODES", top)
    monkeypatch.setattr(knn, "FAN", 1)
    monkeypatch.setattr(knn, "SHARE", share)
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    monkeypatch.setattr(knn, "RECEIVER_ROWS", 8)
    df, x, _, cols = table(spark)
    model = MissingValues(method="knn", columns=cols, neighbors=5).fit(df)
    got = collected(model.transform(df), cols)
    np.testing.assert_allclose(got, brute_fill(x, x, 5, np.nanmean(x, axis=0)), atol=1e-9)


@pytest.mark.parametrize("top", [10**6, 2])
def test_imputer_by_group(spark, monkeypatch, top):
    monkeypatch.setattr(knn, "TOP_NODES", top)
    monkeypatch.setattr(knn, "FAN", 1)
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    monkeypatch.setattr(knn, "RECEIVER_ROWS", 8)
    df, x, g, cols = table(spark, n=300, rare=(7, 8, 9), quarters=False)
    model = MissingValues(method="knn_brandwise", columns=cols, neighbors=5).fit(df)
    got = collected(model.transform(df), cols)
    for name in np.unique(g):
        part = x[g == name]
        m, s = np.nanmean(part, axis=0), np.nanstd(part, axis=0)
        s[s == 0] = 1
        z = (part - m) / s
        want = brute_fill(z, z, 5, np.zeros(len(cols))) * s + m
        np.testing.assert_allclose(got[g == name], want, atol=1e-9)


def test_unseen_group_takes_training_mean(spark):
    df, x, _, cols = table(spark, n=60)
    model = MissingValues(method="knn_brandwise", columns=cols).fit(df)
    new = spark.createDataFrame([(900, "zzz", None, 1.0, None)], df.schema)
    row = model.transform(new).first()
    assert row["c0"] == pytest.approx(np.nanmean(x[:, 0]))
    assert row["c1"] == 1.0


def test_repeated_donors_keep_the_lowest_ids(spark, monkeypatch):
    monkeypatch.setattr(knn, "TOP_NODES", 1)
    rows = [(i, "a", 1.0, float(i % 3)) for i in range(200)] + [(1000, "a", 1.0, None)]
    df = spark.createDataFrame(rows, "car_id long, brand string, c0 double, c1 double")
    model = MissingValues(method="knn", columns=["c0", "c1"], neighbors=5).fit(df)
    filled = model.transform(df).where("car_id = 1000").first()["c1"]
    assert filled == pytest.approx(np.mean([0, 1, 2, 0, 1]))


def test_saved_imputer_gives_the_same(spark, tmp_path):
    df, _, _, cols = table(spark, n=120)
    model = MissingValues(method="knn_brandwise", columns=cols).fit(df)
    model.save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    np.testing.assert_allclose(collected(again.transform(df), cols), collected(model.transform(df), cols))


def brute_lof(train, query, k, own):
    """Scores of `query` against `train`; `own` when the query rows are the training rows."""
    def near(a, skip):
        d = np.sqrt(((a[:, None] - train[None]) ** 2).sum(-1))
        if skip:
            np.fill_diagonal(d, np.inf)
        at = np.argsort(d, axis=1, kind="stable")[:, :k]
        return at, np.take_along_axis(d, at, 1)

    at, d = near(train, True)
    kdist = d[:, -1]
    density = 1 / (np.maximum(kdist[at], d).mean(1) + 1e-10)
    if own:
        return -density[at].mean(1) / density
    qa, qd = near(query, False)
    mine = 1 / (np.maximum(kdist[qa], qd).mean(1) + 1e-10)
    return -density[qa].mean(1) / mine


@pytest.mark.parametrize("top", [10**6, 2])
def test_local_outlier_factor(spark, monkeypatch, top):
    monkeypatch.setattr(knn, "TOP_NODES", top)
    monkeypatch.setattr(knn, "FAN", 1)
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(190, 2)), rng.uniform(6, 9, size=(10, 2))])
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "car_id long, x double, y double")
    model = Outliers(method="LOF", modelColumns=["x", "y"], neighbors=10).fit(df)
    assert model.numbers["cut"] == pytest.approx(np.percentile(brute_lof(x, x, 10, True), 5))
    got = [r["score"] for r in sorted(model.scores(df).collect(), key=lambda r: r["id"])]
    want = brute_lof(x, x, 10, False)
    np.testing.assert_allclose(got, want, rtol=1e-9)
    kept = {r["car_id"] for r in model.transform(df).collect()}
    assert kept == set(np.flatnonzero(want >= model.numbers["cut"]).tolist())


def test_keys_that_are_no_numbers(spark):
    df, x, _, cols = table(spark, n=120)
    named = df.withColumn("car_id", F.concat(F.lit("car-"), F.lpad(F.col("car_id").cast("string"), 4, "0")))
    model = MissingValues(method="knn", columns=cols, neighbors=5).fit(named)
    got = model.transform(named)
    assert got.columns == named.columns
    np.testing.assert_allclose(collected(got, cols), brute_fill(x, x, 5, np.nanmean(x, axis=0)), atol=1e-9)
    whole = named.na.drop(subset=cols)
    lof_model = Outliers(method="LOF", modelColumns=cols, neighbors=5).fit(whole)
    plain = df.na.drop(subset=cols)
    want = {r["car_id"] for r in Outliers(method="LOF", modelColumns=cols, neighbors=5).fit(plain).transform(plain).collect()}
    assert {int(r["car_id"][4:]) for r in lof_model.transform(whole).collect()} == want


@pytest.mark.parametrize("top", [1])
def test_more_columns_than_a_pattern_and_one_without_values(spark, monkeypatch, top):
    monkeypatch.setattr(knn, "TOP_NODES", top)
    monkeypatch.setattr(knn, "PATTERN_BITS", 2)  # of five columns: the others stand for those past the 63rd
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    monkeypatch.setattr(knn, "RECEIVER_ROWS", 8)
    df, x, _, cols = table(spark, n=60, p=5, gaps=0.2)
    got = collected(MissingValues(method="knn", columns=cols, neighbors=3).fit(df).transform(df), cols)
    np.testing.assert_allclose(got, brute_fill(x, x, 3, np.nanmean(x, axis=0)), atol=1e-9)
    empty = df.select("car_id", "brand", "c0", "c1").withColumn("c2", F.lit(None).cast("double"))
    some = x[:, :3].copy()
    some[:, 2] = np.nan
    got = collected(MissingValues(method="knn", columns=cols[:3], neighbors=3).fit(empty).transform(empty), cols[:3])
    np.testing.assert_allclose(got, brute_fill(some, some, 3, [np.nanmean(x[:, 0]), np.nanmean(x[:, 1]), np.nan]), atol=1e-9)


def test_k_rows_per_receiver_leave_a_task(spark, monkeypatch):
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    df, x, _, cols = table(spark, n=300, gaps=0.0)
    points = knn._points(df, "car_id", None, cols)
    ranges = knn._ranges(points, len(cols))
    donors = knn.build_donors(points, ranges, 4)
    found = knn.nearest(points.withColumn("target", F.lit(knn.ANY)), donors, ranges, 4)
    assert found.count() == 1200
    seen = []
    best = knn._Best(np.arange(50), x[:50], knn.ANY, np.inf, 4, False)
    for low in range(0, 300, 16):
        best.add(np.arange(low, min(low + 16, 300)), x[low:low + 16], 0.0)
        seen.append(np.bincount(best.at, minlength=50).max())
    assert max(seen) == 4
    d = ((x[:50, None] - x[None]) ** 2).sum(-1)
    want = np.argsort(d, axis=1, kind="stable")[:, :4]
    order = np.argsort(best.at, kind="stable")
    assert (best.donor[order].reshape(50, 4) == want).all()


def test_a_block_travels_once_per_tile(spark, monkeypatch):
    monkeypatch.setattr(knn, "DONOR_ROWS", 16)
    monkeypatch.setattr(knn, "RECEIVER_ROWS", 8)
    monkeypatch.setattr(knn, "TILES", 1)
    df, _, _, cols = table(spark, n=300, gaps=0.0)
    points = knn._points(df, "car_id", None, cols).coalesce(1)
    ranges = knn._ranges(points, 3)
    donors = knn.build_donors(points, ranges, 4)
    packed = knn._pack(points.withColumn("target", F.lit(knn.ANY)), ["g", "target"], ranges, 8, "receivers")
    pairs = packed.select(F.col("name").alias("r_name")).crossJoin(donors.select(F.col("name").alias("d_name"))) \
        .withColumn("least", F.lit(0.0))
    none = spark.createDataFrame([], "r_name string, bound double, limits array<double>")
    sent = knn._meeting(packed, none, pairs, donors)
    assert sent.where("own = 0").count() * 4 <= pairs.count()  # before: a copy of the donor block per pair


def test_cells_are_as_long_in_every_column(spark):
    points = spark.range(4096).selectExpr("id", "'' AS g", "(id % 64) * 1000d AS x0", "floor(id / 64) * 1d AS x1", "3L AS pattern")
    cells = knn._with_curve(points, [[0.0, 63000.0], [0.0, 63.0]]).withColumn("block", F.row_number().over(knn.Window.orderBy("z")) / 256)
    wide = cells.groupBy(F.ceil("block").alias("b")).agg((F.max("x0") - F.min("x0")).alias("w")).agg(F.max("w")).first()[0]
    assert wide <= 4000  # before: 15,000, as both columns were halved in turn


def with_gaps(n, p=5, seed=8, gaps=0.15):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p))
    x[:, 0] = np.round(x[:, 0])
    x[rng.random((n, p)) < gaps] = np.nan
    return x[~np.isnan(x).all(axis=1)]


def test_leaves_hold_every_donor_once_and_their_boxes_hold_them(monkeypatch):
    monkeypatch.setattr(knn, "LEAF_ROWS", 16)
    monkeypatch.setattr(knn, "BRANCH", 3)
    x = with_gaps(900)
    d = knn._Donors(np.arange(len(x)), x)
    assert sorted(d.ids) == list(range(len(x))) and np.array_equal(x[d.ids], d.xs, equal_nan=True)
    assert (d.ends - d.start).max() <= 16 and d.leaves.sum() == len(d.start) and d.leaves.max() <= 3
    for a, b, low, high, some in zip(d.start, d.ends, d.low, d.high, d.some):
        cells = d.xs[a:b] - d.centre
        assert not ((cells < low - 1e-12) | (cells > high + 1e-12)).any()
        assert np.array_equal(some, d.has[a:b].any(axis=0))


@pytest.mark.parametrize("target, exclude_self", [(knn.ANY, True), (knn.ANY, False), (2, False)])
def test_rows_meet_few_donors_and_miss_none(monkeypatch, target, exclude_self):
    monkeypatch.setattr(knn, "LEAF_ROWS", 16)
    monkeypatch.setattr(knn, "BESIDE_ROWS", 100)
    monkeypatch.setattr(knn, "PAIRS", 500)
    x = with_gaps(3000, gaps=0.03)
    ids = np.arange(len(x)) // 2 * 2 if exclude_self else np.arange(len(x))  # keys may repeat
    rows = x[:400].copy()
    if target != knn.ANY:
        rows[:, target] = np.nan
    met = []
    plain = knn._Best._meet
    monkeypatch.setattr(knn._Best, "_meet", lambda self, donors, told, slack, at, leaf: (met.append((donors.ends - donors.start)[leaf].sum()),
                                                                                        plain(self, donors, told, slack, at, leaf)))
    best = knn._Best(ids[:400], rows, target, np.inf, 4, exclude_self)
    best.search(knn._Donors(ids, x))
    assert sum(met) < 0.5 * 400 * len(x)
    order = np.lexsort((best.donor, best.d2, best.at))
    for i in range(400):
        both = ~np.isnan(rows[i]) & ~np.isnan(x)
        d2 = np.where(both, (rows[i] - x) ** 2, 0).sum(1) * (x.shape[1] / np.maximum(both.sum(1), 1))
        ok = both.any(axis=1) & (ids != ids[i] if exclude_self else True) & (~np.isnan(x[:, target]) if target != knn.ANY else True)
        want = np.sort(d2[ok])[:4]
        np.testing.assert_allclose(best.d2[order][best.at[order] == i], want, rtol=1e-12)


def test_a_search_in_parts_equals_one(monkeypatch):
    x = with_gaps(500, seed=9)
    whole, parts = (knn._Best(np.arange(80), x[:80], knn.ANY, np.inf, 3, True) for _ in range(2))
    whole.search(knn._Donors(np.arange(len(x)), x))
    for a in range(0, len(x), 70):
        parts.add(np.arange(len(x))[a:a + 70], x[a:a + 70], 0.0)
    for b in (whole, parts):
        b.order = np.lexsort((b.donor, b.d2, b.at))
    assert np.array_equal(whole.donor[whole.order], parts.donor[parts.order]) and np.array_equal(whole.at[whole.order], parts.at[parts.order])
