"""Quantiles, splits, encoders, scalers, selection and models on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import canonical, distributions, encode, gram, iterative, linear, models, selection
from tabloom.operators.impute import MissingValues
from tabloom.operators.outliers import Outliers
from tabloom.operators.quantiles import columns_of, exact_quantiles
from tabloom.operators.scale import Scaler
from tabloom.operators.split import stratified_split
from tabloom.plans.chain import car_preprocessor, preprocessor


def frame(spark, x, names=None):
    names = names or [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "car_id long, " + ", ".join(f"{n} double" for n in names)), names


@pytest.mark.parametrize("shape", ["ties", "spread", "two"])
def test_quantiles_by_narrowing(spark, shape):
    rng = np.random.default_rng(2)
    v = {"ties": np.concatenate([np.full(700, 3.0), rng.normal(size=1300)]),
         "spread": rng.lognormal(size=3000), "two": np.repeat([1.0, 2.0], 500)}[shape]
    df = spark.createDataFrame([(float(a),) for a in v] + [(None,)], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, columns_of(["x"]), probs, direct_rows=0, final_rows=5, accuracy=50)["x"]
    np.testing.assert_allclose(got, np.quantile(v, probs), rtol=1e-12)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert exact_quantiles(df, columns_of(["x"]), [0.25, 0.5])["x"] == [1.75, 2.5]


def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), (None, "z")], "g string, v string")
    got = {r["g"]: r["mode"] for r in distributions.mode_by_group(df, "g", ["v"]).collect()}
    assert got == {"a": "x", "b": None, None: "z"}


def test_split_is_exact_and_stable(spark, monkeypatch):
    from tabloom.operators import split

    monkeypatch.setattr(split, "MODULUS", 7)  # many rows share a code, so ties are ranked
    rows = [(i, "big" if i % 10 else "small") for i in range(101)]
    df = spark.createDataFrame(rows, "car_id long, brand string")
    out = stratified_split(df, "car_id", "brand").collect()
    again = stratified_split(df.repartition(7), "car_id", "brand").collect()
    assert sorted(out) == sorted(again) and len(out) == 101
    assert sum(r["split"] == "validation" for r in out) == 31
    for b, n in (("big", 90), ("small", 11)):
        val = sum(r["split"] == "validation" for r in out if r["brand"] == b)
        assert abs(val - 0.3 * n) <= 1
        codes = sorted((r["car_id"] * 7919 % 7, r["car_id"], r["split"]) for r in out if r["brand"] == b)
        assert [s for *_, s in codes] == sorted(s for *_, s in codes)


def test_encoders(spark):
    df = spark.createDataFrame(
        [(1, "a", "m1", 1.0), (2, "a", "m2", 3.0), (3, "b", "m1", 5.0), (4, "b", None, 7.0)],
        "car_id long, brand string, model string, price double")
    new = spark.createDataFrame([(9, "c", "m9", 0.0), (8, "b", "m1", 0.0), (7, "a", None, 0.0)], df.schema)
    hot = encode.Encoder(method="onehot", columns=["brand"]).fit(df).transform(new)
    assert [(r["brand_a"], r["brand_b"]) for r in hot.collect()] == [(0, 0), (0, 1), (1, 0)]
    strict = encode.Encoder(method="onehot_named", columns=["brand"], handleUnknown="error").fit(df)
    with pytest.raises(Exception, match="unseen category"):
        strict.transform(new).collect()
    target = encode.Encoder(method="target", columns=["model"], label="price").fit(df).transform(new)
    assert [r["model"] for r in target.collect()] == [4.0, 3.0, 4.0]
    freq = encode.Encoder(method="freq", columns=["model"]).fit(df).transform(new)
    assert [r["model"] for r in freq.collect()] == [0.0, pytest.approx(2 / 3), 0.0]
    hybrid = encode.Encoder(method="hybrid").fit(df).transform(new)
    assert {r["car_id"]: (r["brand_a"], r["brand_b"]) for r in hybrid.collect()} == {9: (0, 0), 8: (0, 1), 7: (0, 0)}
    with pytest.raises(ValueError):
        encode.Encoder(method="hybrid").fit(df.drop("model"))
    with pytest.raises(ValueError):
        encode.Encoder(method="target", columns=["model"]).fit(df)


def test_scalers(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 10.0, 5.0)], "car_id long, a double, b double")
    out = Scaler(method="Standard").fit(df).transform(df).orderBy("car_id").collect()
    assert out[0]["a"] == pytest.approx(-3 / 3.5355339) and out[0]["b"] == 0.0
    model = Scaler().fit(df)
    assert [r["b"] for r in model.transform(df).collect()] == [0.0] * 4
    back = model.inverse(model.transform(df)).orderBy("car_id").collect()
    assert [r["a"] for r in back] == pytest.approx([1, 2, 3, 10])
    with pytest.raises((ValueError, TypeError)):
        Scaler(method="nope")


def test_chi_square(spark):
    rows = [("x", "u")] * 10 + [("x", "v")] * 20 + [("y", "u")] * 30 + [("y", "v")] * 5
    df = spark.createDataFrame(rows, "a string, b string")
    row = selection.chi_square(df, "a", "b").first()
    o = np.array([[10, 20], [30, 5]])
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert row["chi2"] == pytest.approx((((np.abs(o - e) - 0.5) ** 2) / e).sum()) and row["dof"] == 1
    rows = [(str(i), str(j)) for i in range(3) for j in range(4) for _ in range((i + 1) * j)]
    got = selection.chi_square(spark.createDataFrame(rows + [("0", "0")], "a string, b string"), "a", "b").first()
    o = np.array([[(i + 1) * j for j in range(4)] for i in range(3)])
    o[0, 0] = 1
    e = o.sum(1, keepdims=True) * o.sum(0) / o.sum()
    assert got["chi2"] == pytest.approx((((o - e) ** 2) / e).sum()) and got["dof"] == 6


def linear_data(n=240, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = 5 * x[:, 0] - 2 * x[:, 1] + 0.1 * x[:, 2] + rng.normal(size=n) * 0.3 + 100
    return x, y


def test_linear_algebra(spark):
    x, y = linear_data()
    df, names = frame(spark, np.column_stack([x, y]))
    m = gram.moments(df, names)[0]
    one = np.column_stack([np.ones(len(x)), x])
    want = np.linalg.lstsq(one, y, rcond=None)[0]
    fit = linear.least_squares(m)
    np.testing.assert_allclose([fit.intercept, *fit.coef], want, rtol=1e-8)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc)
    np.testing.assert_allclose(linear.least_squares(m, 1.0).coef, ridge, rtol=1e-8)
    w = linear.lasso(m, 0.5)
    grad = xc.T @ (yc - xc @ w) / len(x)  # optimality of the lasso
    assert np.all(np.abs(grad[w == 0]) <= 0.5 + 1e-6)
    np.testing.assert_allclose(grad[w != 0], 0.5 * np.sign(w[w != 0]), atol=1e-6)


def test_elimination_path(spark):
    x, y = linear_data()
    df, names = frame(spark, np.column_stack([x, y]))
    df = df.withColumn("split", F.when(F.col("car_id") < 160, "train").otherwise("validation"))
    rows = selection.rfe_scores(df, names[:4], names[4]).collect()
    assert [r["n"] for r in rows] == [1, 2, 3, 4] and sum(r["best"] for r in rows) == 1
    assert rows[0]["features"] == ["x0"] and rows[1]["features"] == ["x0", "x1"]
    one = np.column_stack([np.ones(160), x[:160, :2]])
    b = np.linalg.lstsq(one, y[:160], rcond=None)[0]
    p = np.column_stack([np.ones(80), x[160:, :2]]) @ b
    want = 1 - ((y[160:] - p) ** 2).sum() / ((y[160:] - y[160:].mean()) ** 2).sum()
    assert rows[1]["val_r2"] == pytest.approx(want, rel=1e-8)


def test_pairwise_correlations_skip_gaps(spark):
    x, _ = linear_data(60)
    x[:, 3] = 2.0
    x[::7, 1] = np.nan
    df, names = frame(spark, x)
    got = gram.pairwise_correlations(df, names)
    ok = ~np.isnan(x[:, 1])
    assert got[0, 1] == pytest.approx(np.corrcoef(x[ok, 0], x[ok, 1])[0, 1])
    assert np.isnan(got[0, 3])
    long = {(r["feature_a"], r["feature_b"]): r["corr"] for r in distributions.correlations(df, names).collect()}
    assert long["x0", "x1"] == pytest.approx(got[0, 1]) and long["x0", "x3"] is None


def test_iterative_matches_plain_rounds(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 3)) @ np.array([[1, 0.5, 0.2], [0, 1, 0.7], [0, 0, 1]])
    x[rng.random(x.shape) < 0.1] = np.nan
    df, names = frame(spark, x)
    state = iterative.fit(df, names, max_iter=3, tol=0.0)
    means, order = np.nanmean(x, 0), sorted(range(3), key=lambda j: (np.isnan(x[:, j]).sum(), j))
    filled, miss = np.where(np.isnan(x), means, x), np.isnan(x)
    for step, (target, coef, b) in enumerate(state["steps"]):
        assert target == order[step % 3]
        rows = ~miss[:, target]
        part = filled[rows]
        m = gram.Moments(rows.sum(), part.sum(0), part.T @ part, np.zeros(3))
        want, want_b = iterative.bayesian_ridge(m, target)
        np.testing.assert_allclose([*coef, b], [*want, want_b], rtol=1e-6, atol=1e-9)
        filled[miss[:, target], target] = filled[miss[:, target]] @ np.asarray(coef) + b
    model = MissingValues(method="iterative", columns=names, maxIter=3, tol=0.0).fit(df)
    got = np.array([[r[c] for c in names] for r in model.transform(df).orderBy("car_id").collect()])
    np.testing.assert_allclose(got, filled, rtol=1e-6)


def greedy(names):
    """The visits of one group, one by one; names in first-seen order."""
    from tabloom.functions.fuzzy import ratio

    words = {n: " ".join(sorted(n.split())) for n in names}
    assigned = {}
    for u in names:
        if u in assigned:
            continue
        scored = sorted(((-ratio(words[u], words[m]), i, m) for i, m in enumerate(names)))[:5]
        for s, _, m in scored:
            if -s >= (90 if len(u) < 4 else 75):
                assigned[m] = u
    return {n: assigned.get(n, n) for n in names}


def test_canonical_names_match_the_visits(spark):
    rng = np.random.default_rng(8)
    base = ["golf", "golf plus", "plus golf", "polo", "tiguan", "tiguan allspace", "up", "ups", "x1", "x2"]
    names = []
    for _ in range(120):
        n = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, 3)):
            at = rng.integers(len(n) + 1)
            if rng.random() < 0.5 and len(n) > 1:
                n.pop(min(at, len(n) - 1))
            else:
                n.insert(at, "abgl"[rng.integers(4)])
        names.append(" ".join("".join(n).split()))
    names = [n for n in dict.fromkeys(names) if n]
    rows = [(i, "vw", n) for i, n in enumerate(names)] + [(500 + i, "audi", n) for i, n in enumerate(reversed(names[:20]))]
    df = spark.createDataFrame(rows, "car_id long, brand string, model string")
    got = {(r["brand"], r["model"]): r["canonical"]
           for r in canonical.canonical_models(df, "car_id", "brand", "model").collect()}
    for brand, seen in (("vw", names), ("audi", list(reversed(names[:20])))):
        assert {n: got[brand, n] for n in seen} == greedy(seen)


def test_isolation_forest_drops_far_points(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(size=(285, 2)), rng.uniform(8, 12, size=(15, 2))])
    df, names = frame(spark, x)
    model = Outliers(method="Isolation_Forest", modelColumns=names).fit(df)
    kept = {r["car_id"] for r in model.transform(df).collect()}
    assert len(kept) == 285 and len(kept & set(range(285, 300))) <= 2
    again = Outliers(method="Isolation_Forest", modelColumns=names).fit(df.repartition(5))
    assert again.numbers["cut"] == pytest.approx(model.numbers["cut"])


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 3.0, 3.0), ("b", 1.0, 2.0), ("b", 3.0, 2.0), ("c", 2.0, 1.0), ("c", 2.0, 1.0)],
                               "g string, y double, p double")
    got = {r["g"]: (r["r2"], r["mae"], r["rmse"]) for r in models.regression_metrics(df, "y", "p", ["g"]).collect()}
    assert got == {"a": (1.0, 0.0, 0.0), "b": (0.0, 1.0, 1.0), "c": (0.0, 1.0, 1.0)}


def car_rows(spark, n=90):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(n):
        num = [float(v) for v in rng.normal(50, 10, size=7)]
        if i % 9 == 0:
            num[i % 7] = None
        brand = ["a", "b"][i % 2]
        rows.append((i, brand, f"m{i % 3}" if i % 11 else None, ["Manual", "Unknown", "Automatic"][i % 3],
                     ["Petrol", "Other", None][i % 3], *num, 100.0 + i, "train" if i < 60 else "validation"))
    cols = "car_id long, brand string, model string, transmission string, fuel_type string, car_age double, mileage double, " \
           "engine_size double, paint_quality double, previous_owners double, tax double, mpg double, price double, split string"
    return spark.createDataFrame(rows, cols)


def test_chain_saves_and_never_sees_validation(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = car_rows(spark)
    train, val = df.where("split = 'train'"), df.where("split <> 'train'")
    model = car_preprocessor().fit(train)
    out = model.transform(df).orderBy("car_id").collect()
    assert len(out) == 90 and not any(v is None for r in out for v in r)
    model.write().overwrite().save(str(tmp_path / "chain"))
    again = PipelineModel.load(str(tmp_path / "chain")).transform(df).orderBy("car_id").collect()
    assert again == out
    changed = val.withColumn("mileage", F.col("mileage") * 100)
    moved = car_preprocessor().fit(train).transform(train.unionByName(changed)).where("split = 'train'")
    assert moved.orderBy("car_id").collect() == [r for r in out if r["split"] == "train"]


def test_class_order_chain(spark):
    df = car_rows(spark)
    chain = preprocessor(outliers=Outliers(zColumns=["mileage"]),
                         encoder=encode.Encoder(columns=["brand", "model", "fuel_type", "transmission"]))
    out = chain.fit(df.where("split = 'train'")).transform(df)
    assert out.where("mileage is null").count() == 0 and "brand_a" in out.columns


def test_scoreboard(spark):
    votes = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "feature string, method string")
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "feature string")
    got = {r["feature"]: (r["votes"], r["share"], r["flagged"]) for r in selection.scoreboard(votes, names).collect()}
    assert got == {"a": (2, 0.5, True), "b": (1, 0.25, False), "c": (0, 0.0, False)}


def test_constant_columns_have_no_correlation_at_any_width(spark):
    """A constant far from zero leaves rounding dust in sums; the rule goes by its ends, pair by pair."""
    from tabloom.operators import distributions

    for width in (3, 13):
        names = [f"c{i}" for i in range(width)]
        rows = [(1e9 + 0.1, float(i % 7), float(i) if i % 2 else None, *[float((i * k) % 11) for k in range(3, width)]) for i in range(60)]
        df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
        got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in distributions.correlations(df, names).collect()}
        assert all(got["c0", c] is None for c in names[1:]) and len(got) == width * (width - 1) // 2
        x, y = zip(*[(r[1], r[2]) for r in rows if r[2] is not None])
        assert got["c1", "c2"] == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_codes_of_a_group_that_many_tasks_share(spark):
    from tabloom.operators import encode

    rows = [("big", f"v{i:05d}") for i in range(3000)] * 2 + [("small", "b"), ("small", "a"), (None, "x"), ("small", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        codes = encode.group_codes(df, "g", "v", 1)
        got = {(r["g"], r["v"]): r["code"] for r in codes.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {("big", f"v{i:05d}"): i + 1 for i in range(3000)} | {("small", "a"): 1, ("small", "b"): 2}
    assert got == want


def test_crosstab_of_many_values_is_sparse(spark):
    from tabloom.operators import distributions as d

    df = spark.range(5000).selectExpr("concat('g', id % 3) AS a", "concat('v', id % 1200) AS b") \
        .union(spark.sql("SELECT 'g0' AS a, CAST(NULL AS STRING) AS b"))
    got = {(r["a"], k): n for r in d.crosstab(df, "a", "b").collect() for k, n in r["counts"].items()}
    assert got == {(r["a"], r["b"]): r["n"] for r in d.crosstab_long(df, "a", "b").collect()} and len(got) == 1200
    few = df.where("b IN ('v1', 'v2', 'v3')")
    wide = {(r["a"], k): r[k] for r in d.crosstab(few, "a", "b").collect() for k in ("v1", "v2", "v3") if r[k]}
    assert wide == {(r["a"], k): n for r in d.crosstab_sparse(few, "a", "b").collect() for k, n in r["counts"].items()}


def test_ranks_of_a_window_share_a_sketch(spark, monkeypatch):
    from tabloom.operators import quantiles

    sketches, plain = [], F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda x, p, a: sketches.append(len(p)) or plain(x, p, a))
    df, _ = frame(spark, np.arange(999.0).reshape(-1, 1), ["x"])
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = exact_quantiles(df, columns_of(["x"]), probs, direct_rows=0, final_rows=5000)["x"]
    np.testing.assert_allclose(got, np.quantile(np.arange(999.0), probs))
    assert len(sketches) == 1  # before: one for each rank


def test_the_split_counts_its_rows_once(spark, monkeypatch):
    from tabloom.operators import split

    rows = spark.range(50).selectExpr("id AS car_id", "'a' AS brand")
    seen = []
    plain = split.settle
    monkeypatch.setattr(split, "settle", lambda df, label, *a: seen.append(label) or plain(df, label, *a))
    assert stratified_split(rows, "car_id", "brand").count() == 50
    assert "codes" not in seen  # past 20,000 counters it was evaluated twice
