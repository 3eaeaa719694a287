"""Model fits, comparison, importances, votes and selection by name on small frames with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import models as M
from tabloom.operators import selection as S
from tabloom.operators.cleaning import drop_columns

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(11)
    x = draw.normal(size=(300, 3))
    return x, 3 * x[:, 0] - 2 * x[:, 1] + 5 + 0.01 * draw.normal(size=300)


@pytest.fixture(scope="module")
def data(spark, rows):
    x, y = rows
    kinds = np.select([x[:, 0] > 0.5, x[:, 1] > 0], ["p", "q"], "r")
    return spark.createDataFrame([(i, *map(float, r), float(v), "train" if i % 3 else "validation", str(k))
                                  for i, (r, v, k) in enumerate(zip(x, y, kinds))],
                                 "id long, a double, b double, c double, y double, split string, k string")


def closed_form(x, y):
    return np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)[0]


def test_linear_fit_and_metrics(data, rows):
    x, y = rows
    train = np.arange(300) % 3 != 0
    beta = closed_form(x[train], y[train])
    got = {r["split"]: r for r in M.evaluate(data, COLS, "y", "linear").collect()}
    for name, use in (("train", train), ("validation", ~train)):
        e = y[use] - np.column_stack([x[use], np.ones(use.sum())]) @ beta
        assert np.isclose(got[name]["rmse"], np.sqrt((e ** 2).mean())) and np.isclose(got[name]["mae"], np.abs(e).mean())
        assert np.isclose(got[name]["r2"], 1 - (e ** 2).sum() / ((y[use] - y[use].mean()) ** 2).sum())
    new = data.where("split <> 'train'").drop("y")
    predicted = M.predict(M.fit_model(data.where("split = 'train'"), COLS, "y", "linear"), new, "y").orderBy("id")
    assert np.allclose([r["y"] for r in predicted.collect()], (np.column_stack([x, np.ones(300)]) @ beta)[~train])


def test_comparison_has_a_row_per_model_and_set(data):
    got = M.compare(data, {"all": COLS, "smaller": ["a", "b"]}, "y", ["linear", "baseline"])
    got = {(r["config"], r["features"]): r for r in got.collect()}
    assert set(got) == {(m, f) for m in ("linear", "baseline") for f in ("all", "smaller")}
    assert all(np.isclose(r["gap"], r["train_r2"] - r["val_r2"]) for r in got.values())
    assert got["baseline", "all"]["train_r2"] > got["baseline", "all"]["val_r2"] > 0.8
    with pytest.raises(ValueError, match="unknown configuration"):
        M.fit_model(data, COLS, "y", "deep")


def test_importances(data, rows):
    x, y = rows
    beta = closed_form(x, y)
    assert np.allclose(S.model_importance(data, COLS, "y", "linear", "regressor"), np.abs(beta[:3]), atol=1e-6)
    forest = S.model_importance(data, COLS, "y", "rf", "regressor")
    assert list(np.argsort(-forest)) == [0, 1, 2] and np.isclose(forest.sum(), 1)
    sizes, squares = (S.model_importance(data, COLS, "k", "linear", "classifier", squared=s) for s in (False, True))
    assert (squares <= 3 * sizes ** 2 + 1e-9).all() and (squares >= sizes ** 2 - 1e-9).all() and (squares > sizes ** 2 + 1e-9).any()
    with pytest.raises(ValueError, match="unknown model"):
        S.model_importance(data, COLS, "y", "tree", "regressor")


def test_selection_keeps_by_name(data):
    for name in ("linear", "rf"):
        top = S.FeatureSelection(method="model", columns=COLS, label="y", k=2, modelName=name, modelType="regressor")
        assert [c for c in top.fit(data).transform(data).columns if c in COLS] == ["a", "b"]
        rfe = S.FeatureSelection(method="rfe", columns=COLS, label="y", nFeatures=1, modelName=name, modelType="regressor")
        assert [c for c in rfe.fit(data).transform(data).columns if c in COLS] == ["a"]
    assert S.rfe_by_model(data, COLS, "k", 2, "linear", "classifier") == ["a", "b"]


def test_votes_and_dropping(spark, data):
    pairs = spark.createDataFrame([("a", "b", 0.9), ("a", "d", 0.8)], "feature_a string, feature_b string, corr double")
    tests = spark.createDataFrame([("a", 0.2), ("c", 0.01), ("d", 0.05)], "feature string, p_value double")
    lasso = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "feature string, coef double")
    ridge = spark.createDataFrame([("a", -0.1), ("b", 5.0), ("c", 0.2), ("d", -3.0), ("e", 9.0)], "feature string, coef double")
    votes = S.votes_of(pairs, tests, lasso, ridge)
    assert sorted(map(tuple, votes.collect())) == sorted([
        ("a", "correlation"), ("b", "correlation"), ("d", "correlation"), ("a", "chi_square"), ("d", "chi_square"),
        ("a", "lasso"), ("a", "ridge"), ("c", "ridge"), ("d", "ridge")])
    names = spark.createDataFrame([(c,) for c in "abcde"], "feature string")
    board = {r["feature"]: (r["votes"], r["share"], r["flagged"]) for r in S.scoreboard(votes, names).collect()}
    assert board == {"a": (4, 1.0, True), "b": (1, 0.25, False), "c": (1, 0.25, False), "d": (3, 0.75, True), "e": (0, 0.0, False)}
    assert drop_columns(data, ["a", "k"]).columns == ["id", "b", "c", "y", "split"]


def test_unscored_rows_stay(spark):
    from tabloom.operators.outliers import Outliers

    draw = np.random.default_rng(5)
    rows = [(i, *map(float, v)) for i, v in enumerate(draw.normal(size=(80, 2)))] + [(80, 50.0, 50.0), (81, None, 0.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    for method in ("Isolation_Forest", "LOF"):
        stage = Outliers(method=method, modelColumns=["x", "y"], key="id", contamination=0.02)
        kept = {r["id"] for r in stage.fit(df.where("id < 81")).transform(df).select("id").collect()}
        assert 81 in kept and 80 not in kept


def test_quantile_jobs_do_not_grow_with_the_ranks(spark):
    from tabloom.operators.quantiles import columns_of, exact_quantiles
    df = spark.range(20_000).select((F.col("id") * 7919 % 20011).cast("double").alias("v")).repartition(3)
    probs = [[0.5], [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]]
    jobs = []
    for i, p in enumerate(probs):
        spark.sparkContext.setJobGroup(f"quantiles-{i}", "count jobs")
        narrowed = exact_quantiles(df, columns_of(["v"]), p, direct_rows=0, final_rows=100)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles-{i}")))
        assert narrowed == exact_quantiles(df, columns_of(["v"]), p)
    spark.sparkContext.setJobGroup("", "")
    assert jobs[1] <= jobs[0] + 4
