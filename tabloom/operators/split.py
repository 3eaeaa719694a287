"""Exact stratified train / validation split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.operators.profile import col
from tabloom.storage import materialize, settle

# Any odd multiplier and prime modulus give a fixed shuffle that every SQL engine can repeat.
MULTIPLIER = 7919
MODULUS = 1_000_003


def shuffle_code(key: Column) -> Column:
    """Arithmetic hash of the key, the shuffle order of the split."""
    return F.pmod(key * F.lit(MULTIPLIER).cast("bigint"), F.lit(MODULUS).cast("bigint"))


def allocations(sizes: DataFrame, stratum: str, test_size: float) -> DataFrame:
    """(stratum, n_train) from (stratum, n): validation gets ceil(test_size * total) rows, shares
    kept by the largest remainder, a tie going to the smaller stratum."""
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_train = total - math.ceil(test_size * total)
    # Products of two row counts need more than 64 bits.
    wide = f"cast(cast(n as decimal(19,0)) * cast({n_train} as decimal(19,0)) as decimal(38,0))"
    share = sizes.select(
        col(stratum),
        F.expr(f"cast({wide} div {max(total, 1)} as bigint)").alias("base"),
        F.expr(f"cast({wide} % {max(total, 1)} as bigint)").alias("rest"),
    )
    spare = n_train - (share.agg(F.sum("base")).first()[0] or 0)
    more = share.orderBy(F.col("rest").desc(), col(stratum)).limit(spare).select(
        col(stratum), F.lit(1).cast("bigint").alias("one")
    )
    return share.join(more, stratum, "left").select(
        col(stratum), (F.col("base") + F.coalesce("one", F.lit(0))).alias("n_train")
    )


def stratified_split(
    df: DataFrame, key: str, stratum: str, test_size: float = 0.3, out: str = "split"
) -> DataFrame:
    """Add `split` = train or validation. Rows need a stratum.

    The first `n_train` rows of a stratum in shuffle order are train. No stratum is sorted: rows
    are counted per (stratum, code), at most `MODULUS` counters each; the code where the running
    count passes `n_train` is the boundary. Only if rows must be told apart at that very code are
    they ranked by key, about one row in `MODULUS`.
    """
    coded = df.withColumn("__code", shuffle_code(col(key)))
    # written at once: `settle` would count a larger table a second time
    counted = materialize(
        coded.groupBy(col(stratum), "__code").agg(F.count(F.lit(1)).alias("__n")), "codes")
    sizes = settle(counted.groupBy(col(stratum)).agg(F.sum("__n").alias("n")), "strata")
    by_code = Window.partitionBy(stratum).orderBy("__code")
    running = counted.withColumn("__upto", F.sum("__n").over(by_code)).join(
        allocations(sizes, stratum, test_size), stratum)
    take = F.col("n_train") - F.col("__upto") + F.col("__n")
    edge = settle(
        running.where((F.col("__upto") >= F.col("n_train")) & (take > 0)).select(
            col(stratum), F.col("__code").alias("__edge"), take.alias("__take"),
            (take < F.col("__n")).alias("__shared")),
        "edge",
    )
    marked = coded.join(edge, stratum, "left")
    train = F.coalesce(F.col("__code") <= F.col("__edge"), F.lit(False))
    if edge.where("__shared").limit(1).count():
        by_key = Window.partitionBy(stratum).orderBy(key)
        tied = marked.where((F.col("__code") == F.col("__edge")) & F.col("__shared")).select(
            col(key), (F.row_number().over(by_key) <= F.col("__take")).alias("__tied"))
        marked = marked.join(settle(tied, "edge_rows"), key, "left")
        train = F.coalesce(F.col("__tied"), train)
    return marked.select(
        *[col(c) for c in df.columns], F.when(train, "train").otherwise("validation").alias(out)
    )
