"""Row and column cleaning of a whole table, the same recipe for every role."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions import numeric as rules
from tabloom.functions import text, typos
from tabloom.operators.categories import infer_from
from tabloom.operators.profile import col


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_null_rows(df: DataFrame, names: list[str]) -> DataFrame:
    return df.dropna(subset=names)


def differs(a: Column, value: str) -> Column:
    """`!=` that lets a missing value pass."""
    return ~a.eqNullSafe(F.lit(value))


def align_columns(df: DataFrame, layout: T.StructType) -> DataFrame:
    """The training layout: its order, without extra columns, missing ones as NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout.fields
        ]
    )


@dataclass(frozen=True)
class CleanRules:
    """Column names and parameters of the cleaning recipe."""

    key: str = "car_id"
    brand: str = "brand"
    model: str = "model"
    year: str = "year"
    age: str = "car_age"
    transmission: str = "transmission"
    fuel: str = "fuel_type"
    non_negative: tuple[str, ...] = ("mileage", "tax", "mpg", "engine_size", "previous_owners")
    non_zero: tuple[str, ...] = ("engine_size",)
    whole: tuple[str, ...] = ("previous_owners",)
    percent: tuple[str, ...] = ("paint_quality",)
    drop: tuple[str, ...] = ("has_damage",)
    reference_year: int = 2024
    brands: dict[str, str] = field(default_factory=typos.brand_table)
    fuels: dict[str, str] = field(default_factory=typos.fuel_table)
    transmissions: dict[str, str] = field(default_factory=typos.transmission_table)


#: The same rules under the column names of the raw file.
RAW_FILE_NAMES = dict(
    key="carID", brand="Brand", model="model", year="year", transmission="transmission",
    fuel="fuelType", non_negative=("mileage", "tax", "mpg", "engineSize", "previousOwners"),
    non_zero=("engineSize",), whole=("previousOwners",), percent=("paintQuality%",),
    drop=("hasDamage",),
)


def clean_numbers(df: DataFrame, r: CleanRules) -> DataFrame:
    """Age from year and every invalid number to NULL, as one projection."""
    out = []
    for name in df.columns:
        c = col(name)
        if name in r.drop:
            continue
        if name == r.year:
            out.append(rules.age_from_year(c, r.reference_year).alias(r.age))
            continue
        if name in r.non_negative:
            c = rules.negative_to_null(c)
        if name in r.non_zero:
            c = rules.zero_to_null(c)
        if name in r.percent:
            c = rules.over_limit_to_null(c)
        if name in r.whole:
            c = rules.floor_whole(c)
        out.append(c.alias(name))
    return df.select(*out)


def clean_categories(df: DataFrame, r: CleanRules) -> DataFrame:
    """Normalise the text columns and map three of them to their canonical names."""
    n = text.normalize_text
    return df.withColumns(
        {
            r.brand: typos.map_values(n(col(r.brand)), r.brands),
            r.model: text.capitalize_first(text.replace_word(n(col(r.model)))),
            r.fuel: typos.map_values(n(col(r.fuel)), r.fuels),
            r.transmission: typos.map_values(n(col(r.transmission)), r.transmissions),
        }
    )


def clean(df: DataFrame, r: CleanRules | None = None, fuzzy: bool = False) -> DataFrame:
    """The whole recipe. `fuzzy` also merges near-equal model names within each brand."""
    from tabloom.operators.canonical import canonical_models, apply_canonical

    r = r or CleanRules()
    df = clean_categories(clean_numbers(df, r), r)
    if fuzzy:
        mapping = canonical_models(df, r.key, r.brand, r.model)
        df = apply_canonical(df, mapping, r.brand, r.model)
        df = df.withColumn(r.model, text.capitalize_first(col(r.model)))
    return infer_from(df, r.key, r.model, r.brand)
