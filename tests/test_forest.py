"""Own forest: the same trees wherever they grow, a replay of the split rule, and known signals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import forest as fo


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(3)
    x = draw.integers(0, 12, (400, 4)).astype(float)
    y = 5 * x[:, 0] - 3 * (x[:, 1] > 5) + draw.normal(0, 0.3, 400)
    rows = [(i, *map(float, r), float(v), "hi" if v > 20 else "lo") for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, k string").repartition(3, "id").cache()


COLS = ["a", "b", "c", "d"]


def tree_of(row):
    return {k: np.frombuffer(row[k], t) for k, t in
            (("column", np.int16), ("cut", np.int16), ("left", np.int32), ("right", np.int32), ("value", np.float64))}


def replay(codes, y, w, tree, g):
    """One tree by recursion over rows, with the same rule written out: (column, cut, left, right) or a mean."""
    def best(rows, path):
        columns = fo._candidates(np.array([path], np.uint64), tree, codes.shape[1], g)[0]
        top = (1e-9, None, None)
        for column in columns:
            for cut in range(g.bins):
                left = codes[rows, column] <= cut
                if min(left.sum(), (~left).sum()) < max(g.least_leaf, 1):
                    continue
                s = [(w[rows][m] * y[rows][m]).sum() ** 2 / w[rows][m].sum() for m in (left, ~left)]
                gain = sum(s) - (w[rows] * y[rows]).sum() ** 2 / w[rows].sum()
                if gain > top[0]:
                    top = (gain, column, cut)
        return top

    def build(rows, path, depth):
        mean = (w[rows] * y[rows]).sum() / w[rows].sum()
        if len(rows) < max(g.least_split, 2) or y[rows].min() == y[rows].max() or (g.depth and depth >= g.depth):
            return mean
        gain, column, cut = best(rows, path)
        if column is None:
            return mean
        left = codes[rows, column] <= cut
        here = np.array([path], np.uint64)
        return (int(column), int(cut), build(rows[left], fo._children(here, False)[0], depth + 1),
                build(rows[~left], fo._children(here, True)[0], depth + 1))

    return build(np.flatnonzero(w > 0), fo.ROOT, 0)


def nested(t, at=0):
    if t["column"][at] < 0:
        return float(t["value"][at])
    return (int(t["column"][at]), int(t["cut"][at]), nested(t, t["left"][at]), nested(t, t["right"][at]))


@pytest.mark.parametrize("g", [
    fo.Growth(trees=3, columns="sqrt", bins=16), fo.Growth(trees=2, columns="all", bootstrap=False, least_split=5, least_leaf=2, bins=16),
    fo.Growth(trees=2, columns="0.5", depth=3, bins=16)])
def test_trees_equal_a_replay(g):
    draw = np.random.default_rng(1)
    codes, h = draw.integers(0, 16, (120, 4)).astype(np.uint8), draw.integers(0, 2**62, 120)
    y = draw.integers(0, 1000, 120).astype(float)
    for tree in range(g.trees):
        w = fo.row_weights(h, tree, g)
        t, _ = fo.grow(codes, y[:, None], w, tree, fo.ROOT, 0, g)
        row = fo._packed(t)
        assert nested(tree_of(row)) == replay(codes, y, w.astype(float), tree, g)


def test_the_place_of_work_changes_nothing(data):
    g = fo.Growth(trees=4, columns="sqrt", bins=16)
    predictions, importances = [], []
    for bound in (10**9, 60, 0):
        f = fo.fit(data, COLS, "y", g, local_rows=bound)
        predictions.append([r[0] for r in f.transform(data).orderBy("id").select("prediction").collect()])
        importances.append(f.importances())
        assert (bound < 400) == bool(any(f.top.values()))
    assert predictions[0] == predictions[1] == predictions[2]
    assert np.allclose(importances[0], importances[1]) and np.allclose(importances[0], importances[2])


def test_signal_and_importance(data):
    f = fo.fit(data, COLS, "y", fo.Growth(trees=20, bins=32))
    worth = f.importances()
    assert worth.argmax() == 0 and abs(worth.sum() - 1) < 1e-9 and worth[0] > 0.8
    error = f.transform(data).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 0.6
    classes = fo.fit(data, COLS, "k", fo.Growth(trees=10, columns="sqrt"), classes=True)
    assert classes.transform(data).where("prediction = k").count() > 380


def test_bad_rows(data):
    with pytest.raises(ValueError, match="no row has a label"):
        fo.fit(data.where("false"), COLS, "y")
    with pytest.raises(Exception, match="missing values"):
        fo.fit(data.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), COLS, "y", fo.Growth(trees=1))
    flat = fo.fit(data.withColumn("y", F.lit(7.0)), COLS, "y", fo.Growth(trees=2))
    assert flat.transform(data).select("prediction").distinct().collect()[0][0] == 7.0


@pytest.mark.parametrize("depth, bootstrap", [(0, True), (2, False)])
def test_large_leaves_are_closed_above(spark, monkeypatch, depth, bootstrap):
    draw = np.random.default_rng(5)
    x = draw.integers(0, 6, (300, 2))
    rows = [(float(a), float(b), float(3 * a + b)) for a, b in x] + [(9.0, 9.0, float(i % 7)) for i in range(150)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(3)
    g = fo.Growth(trees=2, depth=depth, bootstrap=bootstrap, bins=16)
    plain, held = fo._finish, []

    def finish(data, top, closed, g, p):
        held.append(closed)
        return plain(data, top, closed, g, p)

    monkeypatch.setattr(fo, "_finish", finish)
    above = fo.fit(df, ["a", "b"], "y", g, local_rows=20)
    whole = fo.fit(df, ["a", "b"], "y", fo.Growth(trees=2, depth=depth, bootstrap=False, bins=16), local_rows=10_000)
    assert all(held[0][t] for t in range(2))
    parts = above.parts.select("tree", "path").collect()
    assert {(t, int(np.array(n, np.uint64).astype(np.int64))) for t in held[0] for n in held[0][t]} <= {tuple(r) for r in parts}
    assert len(set(parts)) == len(parts)
    got = above.transform(df).toPandas().sort_values(["a", "b", "y"])["prediction"].to_numpy()
    assert len(got) == len(rows)
    if not bootstrap:
        want = whole.transform(df).toPandas().sort_values(["a", "b", "y"])["prediction"].to_numpy()
        assert np.array_equal(got, want)


@pytest.mark.parametrize("local_rows", [200_000, 60])
def test_the_same_trees_however_the_table_is_cut(spark, data, local_rows):
    twice = data.union(data.where("id < 40")).union(data.where("id < 40"))  # equal rows draw weights of their own
    g = fo.Growth(trees=3, columns="sqrt", seed=5)
    forests = [fo.fit(twice.repartition(n), COLS, "y", g, local_rows=local_rows) for n in (1, 7)]
    one, seven = (fo.frame_of(f.parts) for f in forests)
    assert one.equals(seven) and forests[0].top == forests[1].top and len(one)
    twin = fo._numbered(twice, COLS, "y", "double").groupBy("__h").count()
    assert twin.where("count > 1").count() == 0


def test_equal_rows_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(fo, "TOGETHER", 7)
    same = spark.range(100).selectExpr("1.0D AS a", "2.0D AS y")
    rows = fo._numbered(same, ["a"], "y", "double")
    assert rows.count() == 100 and rows.select("__h").distinct().count() == 100


def test_prediction_keeps_the_trees_in_place(spark, data, monkeypatch):
    f = fo.fit(data, COLS, "y", fo.Growth(trees=20, columns="sqrt", bins=16), local_rows=60)
    near = f.transform(data).orderBy("id").select("prediction").collect()
    plan = f.transform(data)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" not in plan  # neither rows nor trees were copied for every pair of chunks
    monkeypatch.setattr(fo, "LOCAL_ROWS", 10)
    monkeypatch.setattr(fo, "ROW_CHUNK", 70)
    assert f.transform(data).orderBy("id").select("prediction").collect() == near


@pytest.mark.parametrize("classes", [False, True])
def test_batches_of_nodes_change_nothing(monkeypatch, classes):
    draw = np.random.default_rng(2)
    codes, h = draw.integers(0, 16, (600, 5)).astype(np.uint8), draw.integers(0, 2**62, 600)
    y = np.eye(3)[draw.integers(0, 3, 600)] if classes else draw.integers(0, 1 << 24, (600, 1)).astype(float)
    for columns in ("sqrt", "all"):
        g = fo.Growth(columns=columns, bins=16, least_leaf=2, least_split=5)
        grown = []
        for rows in (1, 50, 10_000):  # every node from histograms, some, none
            monkeypatch.setattr(fo, "BATCH_ROWS", rows)
            t, gains = fo.grow(codes, y, fo.row_weights(h, 0, g), 0, fo.ROOT, 0, g)
            grown.append((walked(t), gains))
        assert grown[0][0] == grown[1][0] == grown[2][0]
        assert np.allclose(grown[0][1], grown[2][1]) and np.allclose(grown[0][1], grown[1][1])


def walked(t, at=0):
    if t.column[at] < 0:
        return tuple(t.value[at])
    assert t.right[at] == t.left[at] + 1
    return (int(t.column[at]), int(t.cut[at]), walked(t, t.left[at]), walked(t, t.right[at]))


def test_stored_trees_are_small_and_lead_to_the_same_leaves(monkeypatch):
    draw = np.random.default_rng(4)
    for p in (4, 300):  # a column number of one byte and of two
        codes, h = draw.integers(0, 128, (500, p)).astype(np.uint8), draw.integers(0, 2**62, 500)
        g = fo.Growth(columns="all")
        t, _ = fo.grow(codes, draw.integers(0, 1000, (500, 1)).astype(float), fo.row_weights(h, 0, g), 0, fo.ROOT, 0, g)
        stored = fo._stored(t)
        assert len(stored["nodes"]) + len(stored["value"]) < sum(map(len, fo._packed(t).values())) / 2
        monkeypatch.setattr(fo, "PASS_ROWS", 64)
        got = fo._leaf_values(stored, codes, 1)[:, 0]
        for i in range(0, 500, 7):
            at = 0
            while t.column[at] >= 0:
                at = t.right[at] if codes[i, t.column[at]] > t.cut[at] else t.left[at]
            assert got[i] == t.value[at][0]


def test_sums_of_predictions_leave_a_task_in_blocks(spark, data, monkeypatch):
    monkeypatch.setattr(fo, "SUM_ROWS", 150)
    f = fo.fit(data, COLS, "y", fo.Growth(trees=6, columns="sqrt", bins=16))
    near = [r[0] for r in f.transform(data).orderBy("id").select("prediction").collect()]
    monkeypatch.setattr(fo, "HELD_BYTES", 1000)  # the table is too large to be held
    assert [r[0] for r in f.transform(data).orderBy("id").select("prediction").collect()] == near and len(near) == 400
    above = fo.fit(data, COLS, "y", fo.Growth(trees=2, columns="sqrt", bins=16), local_rows=10**9)
    assert all(above.top.values()) and above.size > 0  # grown by scans, whatever the number of rows allows
