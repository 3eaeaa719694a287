"""Helpers that several operators share: tables, joins on hot keys, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.storage import materialize

#: Separators of words, and words themselves, as regular expressions.
GAP = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Copies of a lookup row, so that a hot key of the other side is spread over as many tasks.
SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def salted_lookup(
    big: DataFrame, small: DataFrame, key: str, spread_by: Column, salts: int = SALTS, null_safe: bool = False,
    merge: bool = False,
) -> DataFrame:
    """Left join of `big` with the unique keys of `small`, by shuffle, with every key's rows of `big`
    spread over `salts` tasks. Neither side is broadcast by a hint, as both grow with the data; with `merge`
    Spark is told not to choose it either, where it would go by the size of a compressed file."""
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    right = right.withColumnRenamed(key, "_key").withColumnRenamed("_salt", "_salt2")
    same = F.col(key).eqNullSafe(F.col("_key")) if null_safe else F.col(key) == F.col("_key")
    return left.join(right.hint("merge") if merge else right, same & (F.col("_salt") == F.col("_salt2")), "left").drop("_salt", "_salt2", "_key")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links (a, b): one row (node, component) per node that has a
    link, where component is the smallest node reachable.

    Every round hooks each node to its smallest neighbour, follows the hooks to their ends by jumping (each
    node takes the hook of its hook, so a chain of n hooks takes log n jumps), and rewrites the links to
    the ends, until no link joins two different nodes; then the ends of all rounds are followed from the
    last to the first. Each step is written to the shared folder, so a lost executor costs one step at most.
    Minima are taken before the shuffle and lookups are salted, so a node with very many links is no single
    task.
    """
    links = materialize(edges.select("a", "b").where("a <> b").distinct(), "links")
    hooks = []
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        hook = materialize(hook.select("node", F.least("node", "low").alias("parent")), "hooks")
        hook = _jumped(hook)
        hooks.append(hook)
        links = materialize(_rewrite(links, hook).where("a <> b").distinct(), "links")
    if not hooks:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = hooks[-1].withColumnRenamed("parent", "component")
    for hook in reversed(hooks[:-1]):
        found = salted_lookup(hook, found.withColumnRenamed("node", "parent"), "parent", F.col("node"), merge=True) \
            .select("node", F.coalesce("component", "parent").alias("component"))
        found = materialize(found, "components")
    return found


def _jumped(hook: DataFrame) -> DataFrame:
    """Each node with the end of its chain of hooks. Every hook is a node of the table."""
    while True:
        # most chains have one hook: only those that go on are looked up
        far = hook.where("node <> parent").select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        longer = salted_lookup(hook, far, "parent", F.col("node"), merge=True).select("node", "parent", "next")
        longer = materialize(longer, "jumps")
        if longer.where("next IS NOT NULL").isEmpty():
            return hook
        hook = longer.select("node", F.coalesce("next", "parent").alias("parent"))


def _rewrite(links: DataFrame, hook: DataFrame) -> DataFrame:
    one = salted_lookup(links, hook.withColumnsRenamed({"node": "a", "parent": "pa"}), "a", F.col("b"), merge=True)
    two = salted_lookup(one, hook.withColumnsRenamed({"node": "b", "parent": "pb"}), "b", F.col("a"), merge=True)
    return two.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
