"""Feature selection: statistics, wrapper, embedded methods and the vote over them."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.param import TypeConverters as TC
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.chi2 import p_value
from tabloom.operators import forest, linear
from tabloom.operators.distributions import correlation_matrix, safe_corr
from tabloom.operators.gram import moments
from tabloom.operators.profile import col, stacked
from tabloom.operators.split import shuffle_code
from tabloom.operators.state import Stage, StateModel, one_of, param
from tabloom.storage import materialize


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.7) -> DataFrame:
    return correlation_matrix(df, cols, threshold).where("marked").select("feature_a", "feature_b", "corr")


def chi_square(df: DataFrame, var: str, label: str) -> DataFrame:
    """(feature, chi2, dof, p_value) of one category against the label taken as a category.

    n * (sum of O^2 / (R * C) - 1) needs the non-empty cells only; a 2 x 2 table is corrected by
    half a count per cell, at most by the deviation itself.
    """
    cells = df.where(col(var).isNotNull() & col(label).isNotNull()).groupBy(
        col(var).alias("a"), col(label).alias("b")).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy("a").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("b").agg(F.sum("o").alias("c"))
    size = rows.agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("n_a"))
    across = cols.agg(F.count(F.lit(1)).alias("n_b"))
    inner = cells.join(rows, "a").join(cols, "b").agg(
        F.sum(F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))).alias("q"),
        # Of a 2 x 2 table every cell deviates by the same amount from its expected count.
        F.max_by(F.struct("o", "r", "c"), F.struct("r", "c")).alias("cell"),
    )
    # Three one-row frames folded into one row.
    parts = inner.unionByName(size, True).unionByName(across, True)
    one = parts.agg(*[F.max(c).alias(c) for c in ("q", "cell", "n", "n_a", "n_b")])
    n = F.col("n").cast("double")
    dof = (F.col("n_a") - 1) * (F.col("n_b") - 1)
    r, c, o = (F.col(f"cell.{k}").cast("double") for k in ("r", "c", "o"))
    gap = F.abs(o - r * c / n)
    kept = gap - F.least(F.lit(0.5), gap)
    yates = kept * kept * F.try_divide(n * n * n, r * (n - r) * c * (n - c))
    chi2 = F.when(dof == 1, yates).when(dof > 1, n * (F.col("q") - 1)).otherwise(0.0)
    out = one.select(F.lit(var).alias("feature"), chi2.alias("chi2"), dof.alias("dof"))
    return out.withColumn("p_value", p_value(F.col("chi2"), F.col("dof")))


def independence(df: DataFrame, cols: list[str], label: str, alpha: float = 0.05) -> DataFrame:
    """Chi-square test of every column; `important` where p < alpha."""
    out = chi_square(df, cols[0], label)
    for c in cols[1:]:
        out = out.unionByName(chi_square(df, c, label))
    return out.withColumn("important", F.col("p_value") < alpha)


def variances(df: DataFrame, cols: list[str], threshold: float = 0.0) -> DataFrame:
    """(feature, variance, kept) with the population variance."""
    row = df.agg(*[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(cols)])
    return stacked(row, [
        F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"),
                 (F.col(f"v{i}") > threshold).alias("kept")) for i, c in enumerate(cols)])


def _best(scores: DataFrame, k: int) -> DataFrame:
    """Mark the k highest scores; one row per feature, so the single window task is small."""
    rank = F.row_number().over(Window.orderBy(F.col("score").desc_nulls_last(), "feature"))
    return scores.withColumn("kept", rank <= k)


def anova_scores(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(feature, score): F of each column over the label's classes. Classes are reduced to their
    count, mean and variance first, so only small rows meet."""
    per = df.where(col(label).isNotNull()).groupBy(col(label)).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.var_pop(col(c)).alias(f"v{i}") for i, c in enumerate(cols)],
    )
    aggs = [F.sum("n").alias("n"), F.count(F.lit(1)).cast("double").alias("k")]
    for i in range(len(cols)):
        n, m, v = F.col("n"), F.col(f"m{i}"), F.col(f"v{i}")
        aggs += [F.sum(n * v).alias(f"within{i}"), F.sum(n * m).alias(f"sum{i}"),
                 F.sum(n * m * m).alias(f"square{i}")]
    row = per.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        between = F.col(f"square{i}") - F.col(f"sum{i}") * F.col(f"sum{i}") / F.col("n")
        top = F.try_divide(between, F.col("k") - 1)
        score = F.try_divide(top, F.try_divide(F.col(f"within{i}"), F.col("n") - F.col("k")))
        structs.append(F.struct(F.lit(c).alias("feature"), score.alias("score")))
    return stacked(row, structs)


def regression_scores(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(feature, score): r^2 / (1 - r^2) * (n - 2)."""
    row = df.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[safe_corr(col(c), col(label)).alias(f"r{i}") for i, c in enumerate(cols)],
    )
    structs = []
    for i, c in enumerate(cols):
        r2 = F.col(f"r{i}") * F.col(f"r{i}")
        score = F.try_divide(r2, 1 - r2) * (F.col("n") - 2)
        structs.append(F.struct(F.lit(c).alias("feature"), score.alias("score")))
    return stacked(row, structs)


def k_best(df: DataFrame, cols: list[str], label: str, score_func: str, k: int) -> DataFrame:
    scorers = {"f_classif": anova_scores, "f_regression": regression_scores}
    if score_func not in scorers:
        raise ValueError(f"unknown score function: {score_func}")
    return _best(scorers[score_func](df, cols, label), min(k, len(cols)))


def split_moments(df: DataFrame, cols: list[str], label: str, split: str = "split"):
    """(train, validation) moments with the label last, in one scan."""
    fold = F.when(col(split) == "train", 0).otherwise(1)
    m = moments(df, [*cols, label], fold)
    return m[0], m[1]


def rfe_scores(df: DataFrame, cols: list[str], label: str, split: str = "split") -> DataFrame:
    """(n, train_r2, val_r2, best, features) for every size of recursive elimination; best is the
    highest validation R2 of at least 0, ties to the larger size."""
    path = linear.elimination_path(*split_moments(df, cols, label, split))
    top = max((v for _, _, v in path if v >= 0), default=None)
    best = next((len(kept) for kept, _, v in path if v == top), None)
    rows = [(len(kept), t, v, len(kept) == best, [cols[i] for i in kept]) for kept, t, v in reversed(path)]
    return df.sparkSession.createDataFrame(
        rows, "n int, train_r2 double, val_r2 double, best boolean, features array<string>")


def coefficient_table(df: DataFrame, cols: list[str], coef, method: str) -> DataFrame:
    """(method, feature, coef) from the smallest coefficient up."""
    rows = sorted(zip(cols, map(float, coef)), key=lambda r: (r[1], r[0]))
    frame = df.sparkSession.createDataFrame([(method, *r) for r in rows], "method string, feature string, coef double")
    return frame.orderBy("coef", "feature")


def lasso_cv(df: DataFrame, cols: list[str], label: str, key: str) -> DataFrame:
    """Coefficients of the cross-validated lasso with the chosen penalty."""
    fold = F.pmod(shuffle_code(col(key)), F.lit(linear.LASSO_FOLDS))
    folds = moments(df, [*cols, label], fold)
    fit, alpha = linear.lasso_cv(folds)
    return coefficient_table(df, cols, fit.coef, "lasso").withColumn("alpha", F.lit(alpha))


def ridge(df: DataFrame, cols: list[str], label: str, alpha: float = 1.0) -> DataFrame:
    fit = linear.least_squares(moments(df, [*cols, label])[0], alpha)
    return coefficient_table(df, cols, fit.coef, "ridge")


def zero_counts(coefs: DataFrame) -> DataFrame:
    """(method, picked, eliminated)."""
    return coefs.groupBy("method").agg(
        F.count_if(F.col("coef") != 0).alias("picked"), F.count_if(F.col("coef") == 0).alias("eliminated"))


def votes_of(
    pairs: DataFrame, tests: DataFrame, lasso: DataFrame, ridge: DataFrame, k_ridge: int = 3,
    alpha: float = 0.05,
) -> DataFrame:
    """(feature, method): one row per vote against a feature."""
    either = pairs.select(F.explode(F.array("feature_a", "feature_b")).alias("feature")).distinct()
    weak = ridge.orderBy(F.abs("coef"), "feature").limit(k_ridge)
    parts = [
        either.select("feature", F.lit("correlation").alias("method")),
        tests.where(F.col("p_value") >= alpha).select("feature", F.lit("chi_square").alias("method")),
        lasso.where(F.col("coef") == 0).select("feature", F.lit("lasso").alias("method")),
        weak.select("feature", F.lit("ridge").alias("method")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scoreboard(votes: DataFrame, features: DataFrame, methods: int = 4, limit: float = 0.5) -> DataFrame:
    """(feature, votes, share, flagged) for every feature of the `feature` column."""
    counted = votes.groupBy("feature").agg(F.count(F.lit(1)).alias("v"))
    n = F.coalesce("v", F.lit(0).cast("bigint"))
    share = F.bround(n / F.lit(methods), 2)
    return features.select("feature").join(counted, "feature", "left").select(
        "feature", n.alias("votes"), share.alias("share"), (share >= limit).alias("flagged"))


def assembled(df: DataFrame, cols: list[str], label: str, as_class: bool = False) -> DataFrame:
    """(features, label) for MLlib; a class label is numbered by frequency."""
    out = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    if not as_class:
        return out.select("features", col(label).cast("double").alias("label"))
    source = col(label).cast("string").alias("__class")
    out = out.select("features", source)
    return StringIndexer(inputCol="__class", outputCol="label").fit(out).transform(out).select("features", "label")


def _estimator(model_type: str, n: int):
    """The linear models behind the `model` and `rfe` methods. The logistic penalty is one over the
    number of rows, which equals a unit penalty on the summed loss."""
    if model_type == "classifier":
        return LogisticRegression(maxIter=500, regParam=1.0 / max(n, 1), standardization=False)
    return LinearRegression(regParam=0.0, solver="normal")


def model_importance(
    df: DataFrame, cols: list[str], label: str, model_name: str, model_type: str, seed: int = 42,
    depth: int = 0, squared: bool = False,
) -> np.ndarray:
    """Importance per column: impurity decrease, or the absolute coefficient. For several classes that
    is its largest size over the classes, or with `squared`, the rule of elimination, the sum of squares."""
    classes = model_type == "classifier"
    if model_type not in ("classifier", "regressor") or model_name not in ("rf", "linear"):
        raise ValueError(f"unknown model: {model_name} ({model_type})")
    if model_name == "rf":
        growth = forest.Growth(trees=100, depth=depth, seed=seed, columns="sqrt" if classes else "all")
        return forest.fit(df, cols, label, growth, classes).importances()
    data = materialize(assembled(df, cols, label, classes), "assembled")
    fitted = _estimator(model_type, data.count()).fit(data)
    if model_type == "classifier":
        sizes = np.abs(fitted.coefficientMatrix.toArray())
        return (sizes ** 2).sum(axis=0) if squared else sizes.max(axis=0)
    return np.abs(fitted.coefficients.toArray())


def top_by_model(
    df: DataFrame, cols: list[str], label: str, k: int, model_name: str, model_type: str, seed: int = 42,
    depth: int = 0,
) -> DataFrame:
    """(feature, score, kept) by model importance."""
    scores = model_importance(df, cols, label, model_name, model_type, seed, depth)
    frame = df.sparkSession.createDataFrame(list(zip(cols, map(float, scores))), "feature string, score double")
    return _best(frame, min(k, len(cols)))


def rfe_by_model(
    df: DataFrame, cols: list[str], label: str, keep: int | None, model_name: str, model_type: str,
    seed: int = 42, depth: int = 0,
) -> list[str]:
    """Columns left after dropping the least important one per fit; half of them by default."""
    keep = max(1, len(cols) // 2) if keep is None else keep
    left = list(cols)
    if (model_name, model_type) == ("linear", "regressor"):
        m = moments(df, [*cols, label])[0]
        path = linear.elimination_path(m, m)
        return [cols[i] for i in next(k for k, _, _ in path if len(k) <= max(keep, 1))]
    while len(left) > keep:
        left.pop(int(np.argmin(model_importance(df, left, label, model_name, model_type, seed, depth, True))))
    return left


class FeatureSelection(Stage):
    """variance, kbest, model or rfe; the fitted model keeps the chosen columns by name."""

    method = param("method", "variance, kbest, model, rfe", one_of("variance", "kbest", "model", "rfe"))
    columns = param("columns", "candidate columns", TC.toListString)
    label = param("label", "target", TC.toString)
    threshold = param("threshold", "least variance", TC.toFloat)
    k = param("k", "columns kept by kbest and model", TC.toInt)
    scoreFunc = param("scoreFunc", "f_classif or f_regression", one_of("f_classif", "f_regression"))
    modelType = param("modelType", "classifier or regressor", one_of("classifier", "regressor"))
    modelName = param("modelName", "rf or linear", one_of("rf", "linear"))
    nFeatures = param("nFeatures", "columns kept by rfe", TC.toInt)
    seed = param("seed", "seed of the forests", TC.toInt)
    depth = param("depth", "most levels of the forests, 0 for no limit", TC.toInt)
    DEFAULTS = dict(method="variance", threshold=0.0, k=10, scoreFunc="f_classif",
                    modelType="classifier", modelName="rf", seed=42, depth=0, label="price")

    def _fit(self, train: DataFrame) -> "SelectedModel":
        method, cols, label = self.get("method"), self.get("columns"), self.get("label")
        if cols is None:
            raise ValueError("name the candidate columns")
        model = (self.get("modelName"), self.get("modelType"), self.get("seed"), self.get("depth"))
        if method == "variance":
            table = variances(train, cols, self.get("threshold"))
        elif method == "kbest":
            table = k_best(train, cols, label, self.get("scoreFunc"), self.get("k"))
        elif method == "model":
            table = top_by_model(train, cols, label, self.get("k"), *model)
        else:
            kept = rfe_by_model(train, cols, label, self.get("nFeatures"), *model)
            return SelectedModel({"candidates": cols, "kept": kept})
        chosen = {r["feature"] for r in table.where("kept").collect()}
        return SelectedModel({"candidates": cols, "kept": [c for c in cols if c in chosen]})


class SelectedModel(StateModel):
    """Drops the candidates that were not kept; other columns stay."""

    def _transform(self, df: DataFrame) -> DataFrame:
        gone = [c for c in self.numbers["candidates"] if c not in self.numbers["kept"]]
        return df.drop(*gone)
