"""Categorical encoding from categories learned on training rows."""

from __future__ import annotations

from pyspark.ml.param import TypeConverters as TC
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.profile import col, columns_by_type, value_table
from tabloom.operators.state import Stage, StateModel, one_of, param, replace
from tabloom.storage import materialize, settle

#: One-hot makes one column per category, so their number is checked.
MAX_CATEGORIES = 2000
METHODS = ("onehot", "target", "freq", "hybrid", "label_in_group", "onehot_named")
OTHER = "other"


def categories(train: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted non-null categories of every column; a column may have `MAX_CATEGORIES`, as each of them
    becomes a column."""
    found = value_table(train, cols).where(F.col("value").isNotNull())
    many = found.groupBy("column_name").count().where(F.col("count") > MAX_CATEGORIES).limit(1).collect()
    if many:
        raise ValueError(f"more than {MAX_CATEGORIES} categories in {many[0]['column_name']}; use target or freq encoding")
    rows = found.select("column_name", "value").collect()
    return {c: sorted(r["value"] for r in rows if r["column_name"] == c) for c in cols}


def one_hot(
    df: DataFrame, cats: dict[str, list[str]], prefix: bool = True, kind: str = "int",
    leave_out: list[str] = (), unseen: str = "ignore",
) -> DataFrame:
    """One 0/1 column per category in place of the source columns.

    `prefix=False` names a column by its category alone. `unseen="error"` raises when a row holds
    a category that training did not, or none at all; otherwise such a row is all zero.
    """
    out = [col(c) for c in df.columns if c not in cats]
    for c, values in cats.items():
        known = col(c).isin(values)
        for v in values:
            if v in leave_out:
                continue
            hit = col(c).eqNullSafe(F.lit(v))
            if unseen == "error":
                message = F.concat(F.lit(f"unseen category in {c}: "), F.coalesce(col(c), F.lit("null")))
                hit = F.when(known, hit).otherwise(F.raise_error(message).cast("boolean"))
            out.append(hit.cast(kind).alias(f"{c}_{v}" if prefix else v))
    return df.select(*out)


def label_means(train: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(column_name, value, code): mean label of every category of every column."""
    long = train.select(col(label).alias("__y"), *[col(c).cast("string").alias(c) for c in cols])
    long = long.unpivot(["__y"], [col(c) for c in cols], "column_name", "value")
    means = long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.avg("__y").alias("code")
    )
    return settle(means, "label_means")


def shares(train: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, value, code): share of every category among non-null rows."""
    counted = settle(value_table(train, cols).where(F.col("value").isNotNull()), "value_counts")
    totals = counted.groupBy("column_name").agg(F.sum("n").alias("total"))
    return counted.join(totals, "column_name").select(
        "column_name", "value", (F.col("n") / F.col("total")).alias("code")
    )


def encode_by_table(
    df: DataFrame, codes: DataFrame, cols: list[str], default: float | None
) -> DataFrame:
    """Replace every column by its code; `default` for a category without one."""
    for c in cols:
        table = codes.where(F.col("column_name") == c).select(
            F.col("value").alias("__value"), F.col("code").alias("__code")
        )
        joined = df.join(table, col(c).cast("string") == F.col("__value"), "left")
        df = joined.select(*replace(df, {c: F.coalesce(F.col("__code"), F.lit(default).cast("double"))}))
    return df


def group_codes(train: DataFrame, group: str, value: str, first: int) -> DataFrame:
    """(group, value, code): sorted position of each value inside its group, from `first`.

    The pairs are numbered by a range sort, which splits a large group over tasks; a value's place in its
    task and the counts of the tasks before give its position, so no group is a single task.
    """
    pairs = train.where(col(group).isNotNull() & col(value).isNotNull())
    pairs = pairs.select(col(group), col(value)).distinct()
    pairs = pairs.repartitionByRange(col(group), col(value)).sortWithinPartitions(col(group), col(value))
    placed = materialize(pairs.withColumn("__at", F.monotonically_increasing_id()), "group_values")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    pieces = placed.groupBy(col(group), "__part").agg(F.min("__at").alias("__start"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(col(group)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    code = (F.col("__at") - F.col("__start") + F.col("__before") + first).cast("bigint")
    return settle(placed.join(pieces, [group, "__part"]).select(col(group), col(value), code.alias("code")), "group_codes")


def codes_per_group(
    df: DataFrame, codes: DataFrame, groups: list[str], group: str, value: str, prefix: str
) -> DataFrame:
    """One column per group holding the value's code there, 0 for other groups or unknown values;
    both source columns are dropped."""
    joined = df.join(codes.withColumnRenamed("code", "__code"), [group, value], "left")
    new = [
        F.when(col(group) == F.lit(g), F.coalesce(F.col("__code"), F.lit(0).cast("bigint")))
        .otherwise(F.lit(0).cast("bigint")).alias(f"{prefix}{g}")
        for g in groups
    ]
    return joined.select(*[col(c) for c in df.columns if c not in (group, value)], *new)


def frequent_values(train: DataFrame, cols: list[str], min_freq: float) -> DataFrame:
    """(column_name, value) of the categories whose share reaches `min_freq`."""
    kept = shares(train, cols).where(F.col("code") >= min_freq).select("column_name", "value")
    return settle(kept, "frequent")


def group_rare(df: DataFrame, kept: DataFrame, cols: list[str], other: str = OTHER) -> DataFrame:
    """Replace categories that are not kept by `other`; NULL stays NULL."""
    for c in cols:
        table = kept.where(F.col("column_name") == c).select(F.col("value").alias("__kept"))
        joined = df.join(table, col(c) == F.col("__kept"), "left")
        value = F.when(F.col("__kept").isNotNull(), col(c)).when(col(c).isNotNull(), F.lit(other))
        df = joined.select(*replace(df, {c: value}))
    return df


class Encoder(Stage):
    """All encodings behind one name; see the functions of this module for each."""

    method = param("method", ", ".join(METHODS), one_of(*METHODS))
    columns = param("columns", "columns to encode; all text columns when not given", TC.toListString)
    label = param("label", "target of the target method", TC.toString)
    handleUnknown = param("handleUnknown", "ignore fills unseen categories", TC.toString)
    minFreq = param("minFreq", "share under which categories are grouped as other", TC.toFloat)
    group = param("group", "brand column of the hybrid method", TC.toString)
    value = param("value", "model column of the hybrid method", TC.toString)
    leaveOut = param("leaveOut", "categories that get no column (onehot_named)", TC.toListString)
    DEFAULTS = dict(method="onehot", handleUnknown="ignore", minFreq=0.0, group="brand",
                    value="model", leaveOut=[])

    def _fit(self, train: DataFrame) -> "EncoderModel":
        method, group, value = self.get("method"), self.get("group"), self.get("value")
        numbers = {"method": method, "group": group, "value": value,
                   "leave_out": self.get("leaveOut"), "unknown": self.get("handleUnknown")}
        tables = {}
        if method in ("hybrid", "label_in_group"):
            missing = [c for c in (group, value) if c not in train.columns]
            if missing:
                raise ValueError(f"{method} encoding needs the columns {missing}")
            first = 1 if method == "hybrid" else 0
            tables["codes"] = group_codes(train, group, value, first)
            # one column is made per group, so the groups are few by their nature
            found = value_table(train, [group]).where(F.col("value").isNotNull()).select("value").collect()
            numbers["groups"] = sorted(r["value"] for r in found)
            return EncoderModel(numbers, tables)
        cols = self.get("columns")
        if cols is None:
            cols = columns_by_type(train, numeric=False)
        numbers["columns"] = cols
        if self.get("minFreq") > 0:
            tables["kept"] = frequent_values(train, cols, self.get("minFreq"))
            train = group_rare(train, tables["kept"], cols)
        if method in ("onehot", "onehot_named"):
            numbers["categories"] = categories(train, cols)
        elif method == "target":
            label = self.get("label")
            if label is None:
                raise ValueError("target encoding needs a label")
            tables["codes"] = label_means(train, cols, label)
            mean = train.agg(F.avg(col(label))).first()[0]
            numbers["default"] = mean if self.get("handleUnknown") == "ignore" else None
        else:
            tables["codes"] = settle(shares(train, cols), "shares")
            numbers["default"] = 0.0
        return EncoderModel(numbers, tables)


class EncoderModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        n, method = self.numbers, self.numbers["method"]
        if method in ("hybrid", "label_in_group"):
            prefix = f"{n['group']}_" if method == "hybrid" else ""
            return codes_per_group(df, self.tables["codes"], n["groups"], n["group"], n["value"], prefix)
        if "kept" in self.tables:
            df = group_rare(df, self.tables["kept"], n["columns"])
        if method == "onehot":
            return one_hot(df, n["categories"])
        if method == "onehot_named":
            unseen = "ignore" if n["unknown"] == "ignore" else "error"
            return one_hot(df, n["categories"], prefix=False, kind="double",
                           leave_out=n["leave_out"], unseen=unseen)
        return encode_by_table(df, self.tables["codes"], n["columns"], n["default"])

    def encoding_map(self) -> DataFrame:
        """Code of every value, for the methods that keep one."""
        return self.tables["codes"]
