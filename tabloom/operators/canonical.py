"""Merging near-equal names inside each group, over distinct names only.

The rule is greedy: names are visited in the order they were first seen; a name that no earlier
visit assigned becomes a centre and assigns itself and its close names; the last centre to assign a
name wins. Close means one of the five best scores and at or above a threshold, which is 90 for
names under four letters and 75 for others.

The visits are not replayed one by one. A name is a centre exactly if no centre seen earlier is
close to it, so the centres of all groups are settled together in rounds of joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.fuzzy import ratio_of, signatures_of, sorted_tokens
from tabloom.operators.categories import values_per_group
from tabloom.operators.profile import col
from tabloom.storage import settle

# Fixed values of the rule.
SHORT_LENGTH, SHORT_THRESHOLD, THRESHOLD, BEST = 4, 90.0, 75.0, 5


def threshold(name: Column) -> Column:
    return F.when(F.length(name) < SHORT_LENGTH, SHORT_THRESHOLD).otherwise(THRESHOLD)


def fuzzy_pairs(df: DataFrame, key: str, group: str, value: str, least: float = THRESHOLD) -> DataFrame:
    """(group, a, b, score): name pairs of one group scoring `least` or more, `a` seen first.

    Candidates come from an equality join on signatures; names too different in length drop out in
    the join itself.
    """
    return _pairs(_names(df, key, group, value), least).select(
        F.col("g").alias(group), "a", "b", "score")


def _names(df: DataFrame, key: str, group: str, value: str) -> DataFrame:
    seen = values_per_group(df, key, group, value)
    return settle(
        seen.select(col(group).alias("g"), col(value).alias("name"), F.col("first_seen").alias("at")), "names")


def _pairs(names: DataFrame, least: float) -> DataFrame:
    worded = names.withColumn("words", sorted_tokens(F.col("name"))).withColumn("size", F.length("words"))
    keyed = worded.withColumn("sig", F.explode(signatures_of(F.col("words"), least)))
    side = lambda t: keyed.select(
        "g", "sig", F.col("name").alias(t), F.col("at").alias(f"{t}_at"),
        F.col("words").alias(f"{t}_words"), F.col("size").alias(f"{t}_size"))
    a, b = side("a"), side("b")
    small, both = F.least("a_size", "b_size"), F.col("a_size") + F.col("b_size")
    near = (F.col("a_at") < F.col("b_at")) & (small * 200 >= both * least)
    found = a.join(b, ["g", "sig"]).where(near).drop("sig", "a_size", "b_size").distinct()
    scored = found.withColumn("score", ratio_of(F.col("a_words"), F.col("b_words")))
    return scored.where(F.col("score") >= least).drop("a_words", "b_words")


def _close(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(g, u, u_at, m, m_at): m is close to u, itself included."""
    there = pairs.select("g", F.col("a").alias("u"), F.col("a_at").alias("u_at"),
                         F.col("b").alias("m"), F.col("b_at").alias("m_at"), "score")
    back = pairs.select("g", F.col("b").alias("u"), F.col("b_at").alias("u_at"),
                        F.col("a").alias("m"), F.col("a_at").alias("m_at"), "score")
    own = names.select("g", F.col("name").alias("u"), F.col("at").alias("u_at"),
                       F.col("name").alias("m"), F.col("at").alias("m_at"), F.lit(100.0).alias("score"))
    every = there.unionByName(back).unionByName(own).where(F.col("score") >= threshold(F.col("u")))
    best = Window.partitionBy("g", "u").orderBy(F.col("score").desc(), "m_at")
    return every.withColumn("r", F.row_number().over(best)).where(F.col("r") <= BEST).drop("r", "score")


def _centres(names: DataFrame, close: DataFrame) -> DataFrame:
    """(g, u): the centres. A round settles every name whose earlier close names are settled."""
    before = close.where(F.col("u_at") < F.col("m_at")).select("g", "u", "m")
    status = names.select("g", F.col("name").alias("m"), F.lit(None).cast("boolean").alias("centre"))
    while True:
        earlier = before.join(status.select("g", F.col("m").alias("u"), F.col("centre").alias("c")), ["g", "u"])
        facts = earlier.groupBy("g", "m").agg(
            F.max(F.coalesce("c", F.lit(False))).alias("covered"),
            F.max(F.col("c").isNull()).alias("waits"))
        decided = F.when(F.col("covered"), False).when(F.col("waits"), None).otherwise(True)
        status = settle(
            status.join(facts, ["g", "m"], "left").select(
                "g", "m", F.coalesce("centre", decided).alias("centre")), "centres")
        if not status.where(F.col("centre").isNull()).limit(1).count():
            return status.where("centre").select("g", F.col("m").alias("u"))


def canonical_models(df: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """(group, value, canonical) for every distinct name."""
    names = _names(df, key, group, value)
    close = settle(_close(names, _pairs(names, THRESHOLD)), "close")
    chosen = close.join(_centres(names, close), ["g", "u"]).groupBy("g", "m").agg(
        F.max_by("u", "u_at").alias("canonical"))
    out = names.select("g", F.col("name").alias("m")).join(chosen, ["g", "m"], "left")
    return settle(out.select(F.col("g").alias(group), F.col("m").alias(value),
                             F.coalesce("canonical", "m").alias("canonical")), "canonical")


def apply_canonical(df: DataFrame, mapping: DataFrame, group: str, value: str) -> DataFrame:
    """Replace names by their canonical form; rows without a group or mapping keep theirs."""
    joined = df.join(mapping, [group, value], "left")
    return joined.select(*[
        (F.coalesce("canonical", col(value)) if c == value else col(c)).alias(c) for c in df.columns])


def rename_report(mapping: DataFrame, value: str) -> DataFrame:
    """Names that change, in all groups."""
    return mapping.where(col(value) != F.col("canonical"))
