"""Feature selection queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabloom.operators import selection as S
from tabloom.operators.cleaning import drop_columns
from tabloom.operators.impute import MissingValues
from tabloom.plans import frames
from tabloom.plans.aggregate_queries import corr_sql
from tabloom.plans.chain import car_preprocessor
from tabloom.plans.frames import rounded
from tabloom.plans.registry import query
from tabloom.plans.sqltext import r, register_cte, sql
from tabloom.sources.cars import CATEGORICAL, KEY, LABEL, METRIC
from tabloom.storage import materialize

register_cte("filled", "SELECT car_id, brand, price, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM train)) AS {c}" for c in METRIC) + " FROM train", ["train"])


def filled(spark, sf):
    """Train rows with numbers filled by the mean."""
    rows = frames.train(spark, sf).select(KEY, "brand", LABEL, *METRIC)
    stage = MissingValues(method="simple", strategy="mean", columns=METRIC)
    rows = rows.withColumns({c: F.col(c).cast("double") for c in METRIC})
    return stage.fit(rows).transform(rows)


def matrix(spark, sf, numeric: str = "simple"):
    """Train and validation rows as the models see them, prepared with state from train alone.
    `preprocess_chain` and `predict_prices` run the same chain with the nearest-car fill."""
    rows = materialize(frames.staged_split(spark, sf), "split")
    model = car_preprocessor(numeric=numeric).fit(rows.where(F.col("split") == "train"))
    return materialize(model.transform(rows), "matrix")


def features(df) -> list[str]:
    return [c for c in df.columns if c not in (KEY, LABEL, "split")]


def train_of(df):
    return df.where(F.col("split") == "train")


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


@query("corr_pairs", sql("SELECT * FROM (" + _union([
    corr_sql(a, b, "filled") for a, b in combinations([*METRIC, LABEL], 2)]) + ") WHERE abs(corr) >= 0.3", "filled"))
def corr_pairs(spark, sf):
    return S.correlated_pairs(filled(spark, sf), [*METRIC, LABEL], 0.3)


@query("corr_pairs_encoded")
def corr_pairs_encoded(spark, sf):
    data = matrix(spark, sf)
    return S.correlated_pairs(train_of(data), features(data), 0.7)


def _chi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, {r('n * (q - 1)', 'chi2')}, (n_a - 1) * (n_b - 1) AS dof FROM (
      SELECT sum(CAST(o AS DOUBLE) * o / (CAST(r AS DOUBLE) * c)) AS q, CAST(sum(o) AS DOUBLE) AS n,
             count(DISTINCT a) AS n_a, count(DISTINCT b) AS n_b FROM (
        SELECT a, b, o, sum(o) OVER (PARTITION BY a) AS r, sum(o) OVER (PARTITION BY b) AS c FROM (
          SELECT {c} AS a, price AS b, count(*) AS o FROM train
          WHERE {c} IS NOT NULL AND price IS NOT NULL GROUP BY 1, 2)))"""


@query("chi2_stat", sql(_union([_chi_sql(c) for c in CATEGORICAL]), "train"))
def chi2_stat(spark, sf):
    tests = S.independence(frames.train(spark, sf), CATEGORICAL, LABEL)
    return rounded(tests.select("feature", "chi2", "dof"))


def _tail_sql() -> str:
    """Chance of a chi-square above x by the finite sum of its terms; for an odd number of degrees the terms are
    half a step apart and begin with the normal tail, which is left out where it cannot reach the last digit."""
    half = "(dof % 2) / 2.0::DOUBLE"
    terms = (f"list_transform(range(CAST(dof % 2 AS BIGINT), CAST((dof + 1) // 2 AS BIGINT)), "
             f"lambda k: exp(-x / 2 + (k - {half}) * ln(x / 2) - lgamma(k - {half} + 1)))")
    return f"coalesce(list_sum({terms}), 0.0::DOUBLE)"


@query("chi2_independence", sql(
    f"""SELECT feature, round(x, 6) + 0.0 AS chi2, dof, round(p, 6) + 0.0 AS p_value, p < 0.05 AS important
    FROM (SELECT feature, x, dof, {_tail_sql()} AS p FROM (SELECT feature, chi2 AS x, dof FROM ({_union([_chi_sql(c) for c in CATEGORICAL])})))""", "train"))
def chi2_independence(spark, sf):
    return rounded(S.independence(frames.train(spark, sf), CATEGORICAL, LABEL))


@query("variance_select", sql("SELECT feature, round(v, 3) AS variance, v > 3 AS kept FROM (" + _union([
    f"SELECT '{c}' AS feature, var_pop({c}) AS v FROM filled" for c in METRIC]) + ")", "filled"))
def variance_select(spark, sf):
    return rounded(S.variances(filled(spark, sf), METRIC, 3.0), 3)


def _kept(scores: list[str], k: int) -> str:
    return (f"SELECT feature, {r('score', 'score')}, row_number() OVER (ORDER BY score DESC, feature) <= {k} AS kept "
            f"FROM ({_union(scores)})")


def _anova_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature,
      (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
      FROM (SELECT brand, CAST(count(*) AS DOUBLE) AS n, avg({c}) AS m, var_pop({c}) AS v FROM filled GROUP BY brand),
           (SELECT avg({c}) AS g FROM filled)"""


@query("kbest_anova", sql(_kept([_anova_sql(c) for c in METRIC], 4), "filled"))
def kbest_anova(spark, sf):
    return rounded(S.k_best(filled(spark, sf), METRIC, "brand", "f_classif", 4))


@query("kbest_regression", sql(_kept([
    f"""SELECT '{c}' AS feature, rr / (1 - rr) * (n - 2) AS score
        FROM (SELECT corr({c}, price) * corr({c}, price) AS rr, count(*) AS n FROM filled)""" for c in METRIC], 4), "filled"))
def kbest_regression(spark, sf):
    return rounded(S.k_best(filled(spark, sf), METRIC, LABEL, "f_regression", 4))


_WEAK = 2


def _votes_sql() -> str:
    pairs = [corr_sql(a, b, "filled") for a, b in combinations(METRIC, 2)]
    corr = f"SELECT * FROM ({_union(pairs)}) WHERE abs(corr) >= 0.05"
    low = " UNION ALL ".join(f"SELECT '{c}' AS feature, abs(corr({c}, price)) AS score FROM filled" for c in METRIC)
    flat = " UNION ALL ".join(f"SELECT '{c}' AS feature, var_pop({c}) AS score FROM filled" for c in METRIC)
    return f"""SELECT feature_a AS feature FROM ({corr}) UNION SELECT feature_b FROM ({corr})
      UNION ALL (SELECT feature FROM ({low}) ORDER BY score, feature LIMIT {_WEAK})
      UNION ALL (SELECT feature FROM ({flat}) ORDER BY score, feature LIMIT {_WEAK})"""


@query("vote_scoreboard", sql(
    f"""SELECT f.feature, count(v.feature) AS votes, round_even(count(v.feature) / 3, 2) AS share,
        round_even(count(v.feature) / 3, 2) >= 0.5 AS flagged
    FROM (SELECT unnest({METRIC!r}) AS feature) f LEFT JOIN votes v USING (feature) GROUP BY f.feature""",
    "filled", votes=_votes_sql()))
def vote_scoreboard(spark, sf):
    """Votes of three statistics that SQL can repeat: correlated pairs, low F and low variance."""
    data = filled(spark, sf)
    pairs = S.correlated_pairs(data, METRIC, 0.05)
    either = pairs.select(F.explode(F.array("feature_a", "feature_b")).alias("feature")).distinct()
    low_f = S.regression_scores(data, METRIC, LABEL).orderBy("score", "feature").limit(_WEAK)
    flat = S.variances(data, METRIC).orderBy("variance", "feature").limit(_WEAK)
    votes = either.unionByName(low_f.select("feature")).unionByName(flat.select("feature"))
    names = spark.createDataFrame([(c,) for c in METRIC], "feature string")
    return S.scoreboard(votes, names, methods=3)


def voted_out(data) -> "DataFrame":
    """Scoreboard of the four methods over the prepared train rows and their source categories."""
    cols = features(data)
    train = train_of(data)
    pairs = S.correlated_pairs(train, cols, 0.7)
    lasso, ridge = S.lasso_cv(train, cols, LABEL, KEY), S.ridge(train, cols, LABEL)
    flags = [c for c in cols if c not in METRIC]
    tests = S.independence(train.select(LABEL, *[F.col(f"`{c}`").cast("string").alias(c) for c in flags]), flags, LABEL)
    votes = S.votes_of(pairs, tests, lasso, ridge)
    names = data.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return S.scoreboard(votes, names, methods=4)


@query("vote_scoreboard_models")
def vote_scoreboard_models(spark, sf):
    return voted_out(matrix(spark, sf))


@query("drop_voted")
def drop_voted(spark, sf):
    data = matrix(spark, sf)
    gone = [r["feature"] for r in voted_out(data).where("flagged").collect()]
    return drop_columns(data, gone)


@query("rfe_path")
def rfe_path(spark, sf):
    data = matrix(spark, sf)
    return S.rfe_scores(data, features(data), LABEL)


@query("lasso_cv")
def lasso_cv(spark, sf):
    data = matrix(spark, sf)
    return S.lasso_cv(train_of(data), features(data), LABEL, KEY)


@query("lasso_counts")
def lasso_counts(spark, sf):
    data = matrix(spark, sf)
    return S.zero_counts(S.lasso_cv(train_of(data), features(data), LABEL, KEY))


@query("ridge")
def ridge(spark, sf):
    data = matrix(spark, sf)
    return S.ridge(train_of(data), features(data), LABEL)


@query("importance_forest")
def importance_forest(spark, sf):
    data = matrix(spark, sf)
    return S.top_by_model(train_of(data), features(data), LABEL, 10, "rf", "regressor")


@query("importance_forest_classes")
def importance_forest_classes(spark, sf):
    return S.top_by_model(filled(spark, sf), METRIC, "brand", 4, "rf", "classifier")


@query("importance_linear")
def importance_linear(spark, sf):
    data = matrix(spark, sf)
    return S.top_by_model(train_of(data), features(data), LABEL, 10, "linear", "regressor")


@query("importance_logistic")
def importance_logistic(spark, sf):
    return S.top_by_model(filled(spark, sf), METRIC, "brand", 4, "linear", "classifier")


@query("rfe_model")
def rfe_model(spark, sf):
    """Columns left by eliminating around the logistic model."""
    data = materialize(filled(spark, sf), "filled")
    stage = S.FeatureSelection(method="rfe", columns=METRIC, label="brand", modelName="linear", modelType="classifier")
    return stage.fit(data).transform(data)


@query("rfe_model_linear")
def rfe_model_linear(spark, sf):
    """Columns left by eliminating around the linear model."""
    data = materialize(filled(spark, sf), "filled")
    stage = S.FeatureSelection(method="rfe", columns=METRIC, label=LABEL, modelName="linear", modelType="regressor")
    return stage.fit(data).transform(data)


@query("rfe_model_forest")
def rfe_model_forest(spark, sf):
    """Columns left by eliminating around the forest."""
    data = materialize(filled(spark, sf), "filled")
    stage = S.FeatureSelection(method="rfe", columns=METRIC, label=LABEL, modelName="rf", modelType="regressor")
    return stage.fit(data).transform(data)
