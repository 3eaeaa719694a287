"""Typo tables: a canonical name and its spellings with an end letter missing."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Canonical names of the car data.
BRANDS = ["Audi", "BMW", "Ford", "Hyundai", "Mercedes", "Skoda", "Toyota", "Opel", "VW"]
FUELS = ["Diesel", "Petrol", "Hybrid", "Other", "Electric"]
TRANSMISSIONS = ["Manual", "Semi-Auto", "Automatic", "Unknown", "Other"]

# Spellings the tables leave out although the rule builds them.
BRANDS_EXCLUDE = ["m", "oyot"]
FUELS_EXCLUDE = ["the"]
TRANSMISSIONS_EXCLUDE = ["ther", "othe", "the"]

# Spellings the rule does not build.
FUELS_EXTRA = {"eletric": "Electric", "letric": "Electric", "eletri": "Electric", "letri": "Electric"}

# Under `strict` the electric entry is read letter by letter.
FUELS_STRICT = {letter: "Eletric" for letter in "eletric"}

#: A typo table is a literal map, so it is kept to a size that belongs in an expression.
MAX_VARIANTS = 500


def spellings(name: str) -> list[str]:
    """The lower-case name, without its first, without its last, and without both letters."""
    n = name.lower()
    out = [n, n[1:], n[:-1], n[1:-1]]
    return [s for i, s in enumerate(out) if s and s not in out[:i]]


def typo_table(
    names: list[str], exclude: list[str] = (), extra: dict[str, str] | None = None
) -> dict[str, str]:
    """Spelling to canonical name; raises when two names share a spelling."""
    table: dict[str, str] = {}
    pairs = [(s, n) for n in names for s in spellings(n) if s not in set(exclude)]
    for spelling, name in pairs + list((extra or {}).items()):
        if table.setdefault(spelling, name) != name:
            raise ValueError(f"{spelling!r} could be {table[spelling]!r} or {name!r}")
    if len(table) > MAX_VARIANTS:
        raise ValueError("too many spellings for a literal map; join a lookup table instead")
    return table


def brand_table() -> dict[str, str]:
    return typo_table(BRANDS, BRANDS_EXCLUDE)


def fuel_table(strict: bool = False) -> dict[str, str]:
    """`strict` keeps the original table's slip, which loses every electric car."""
    if strict:
        return typo_table(FUELS[:-1], FUELS_EXCLUDE) | FUELS_STRICT
    return typo_table(FUELS, FUELS_EXCLUDE, FUELS_EXTRA)


def transmission_table() -> dict[str, str]:
    return typo_table(TRANSMISSIONS, TRANSMISSIONS_EXCLUDE)


def map_values(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """Dictionary lookup as an expression: a miss is NULL, or `default` when given."""
    literal = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    found = F.try_element_at(literal, c)
    return found if default is None else F.coalesce(found, default)


def typo_frame(spark: SparkSession, names: DataFrame, name: str) -> DataFrame:
    """Typo table from a column of canonical names held in a table: (spelling, canonical).

    A spelling shared by two names is ambiguous and raises when the frame is evaluated.
    """
    n = F.lower(F.col(name))
    size = F.length(n)
    variants = F.array_distinct(
        F.array(
            n,
            F.substring(n, F.lit(2), size),
            F.substring(n, F.lit(1), size - 1),
            F.substring(n, F.lit(2), F.greatest(size - 2, F.lit(0))),
        )
    )
    exploded = (
        names.where(F.col(name).isNotNull())
        .select(F.explode(variants).alias("spelling"), F.col(name).alias("canonical"))
        .where(F.col("spelling") != "")
    )
    one = exploded.groupBy("spelling").agg(
        F.min("canonical").alias("canonical"), F.max("canonical").alias("other")
    )
    clash = F.raise_error(F.concat(F.lit("ambiguous spelling: "), F.col("spelling")))
    return one.select(
        "spelling",
        F.when(F.col("canonical") == F.col("other"), F.col("canonical"))
        .otherwise(clash.cast("string"))
        .alias("canonical"),
    )
