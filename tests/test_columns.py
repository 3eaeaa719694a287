"""Column functions and cleaning rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tabloom.functions import fuzzy, numeric, text, typos
from tabloom.functions.chi2 import upper_tail
from tabloom.operators import cleaning, profile
from tabloom.sources import files


def values(spark, kind, data, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_normalize_text(spark):
    data = [None, "", "  Class\t A ", "a !", "Semi-Auto", " X Y ", "Café", "a b"]
    assert values(spark, "string", data, text.normalize_text) == [
        None, "", "class a", "a ", "semi-auto", "x y", "caf", "a b"]


def test_word_and_capital(spark):
    assert values(spark, "string", ["c clas", "class a", "clasp", None], text.replace_word) == [
        "c class", "class a", "clasp", None]
    assert values(spark, "string", ["a class", "X", "", None], text.capitalize_first) == ["A class", "X", "", None]


def test_number_rules(spark):
    data = [None, -1.0, 0.0, 50.0, 100.5]
    assert values(spark, "double", data, numeric.negative_to_null) == [None, None, 0.0, 50.0, 100.5]
    assert values(spark, "double", data, numeric.over_limit_to_null) == [None, -1.0, 0.0, 50.0, None]
    assert values(spark, "double", data, numeric.zero_to_null) == [None, -1.0, None, 50.0, 100.5]
    assert values(spark, "double", data, lambda c: numeric.clip(c, 0.0, 60.0)) == [None, 0.0, 0.0, 50.0, 60.0]
    assert values(spark, "double", [0.5, 1.5, 2.5, -0.5], numeric.round_half_even) == [0.0, 2.0, 2.0, 0.0]
    assert values(spark, "double", [2020.7, None], lambda c: numeric.age_from_year(c)) == [4, None]


def test_typo_tables():
    brands = typos.brand_table()
    assert brands["ercede"] == "Mercedes" and brands["v"] == "VW" and brands["udi"] == "Audi"
    assert "m" not in brands and "oyot" not in brands
    assert typos.fuel_table()["eletric"] == "Electric" and "e" not in typos.fuel_table()
    strict = typos.fuel_table(strict=True)
    assert strict["e"] == "Eletric" and "eletric" not in strict
    gears = typos.transmission_table()
    assert gears["nknow"] == "Unknown" and gears["other"] == "Other" and "ther" not in gears
    with pytest.raises(ValueError):
        typos.typo_table(["xab", "yab"])


def test_ambiguous_typo_frame_raises(spark):
    names = spark.createDataFrame([("xab",), ("yab",)], "name string")
    with pytest.raises(Exception, match="ambiguous"):
        typos.typo_frame(spark, names, "name").collect()


def test_lookup_miss_is_null(spark):
    assert values(spark, "string", ["audi", "zzz", None], lambda c: typos.map_values(c, typos.brand_table())) == [
        "Audi", None, None]


def test_ratio():
    assert fuzzy.lcs_length("abcbdab", "bdcaba") == 4
    assert fuzzy.ratio("golf", "glf") == pytest.approx(600 / 7)
    assert fuzzy.ratio("", "") == 100 and fuzzy.ratio("a", "") == 0


def test_signatures_miss_no_close_pair():
    import itertools
    import random

    rng = random.Random(1)
    names = {"".join(rng.choice("ab1 ") for _ in range(rng.randint(1, 7))).strip() for _ in range(250)}
    for least in (75.0, 90.0):
        keys = {n: set(fuzzy.signatures(n, least)) for n in names}
        for a, b in itertools.combinations(sorted(names), 2):
            if fuzzy.ratio(a, b) >= least:
                assert keys[a] & keys[b], (a, b)


def test_chi_square_tail():
    assert upper_tail(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert upper_tail(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert upper_tail(0.0, 3) == 1.0
    assert 0.3 < upper_tail(10000.0, 10000) < 0.6


def test_csv_source_and_sinks(spark, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text("carID,Brand,year,price,paintQuality%\n2,Audi,2019.0,9000.5,55\n1,,,,NaN\n")
    df = files.read_keyed(spark, str(path), "carID", files.RAW_CAR_SCHEMA)
    rows = {r["carID"]: r for r in df.collect()}
    assert rows[1]["Brand"] is None and rows[1]["paintQuality%"] is None and rows[2]["price"] == 9000.5
    files.write_stage(df, str(tmp_path / "stage"))
    assert spark.read.parquet(str(tmp_path / "stage")).count() == 2
    files.write_predictions(df, str(tmp_path / "out"), "carID")
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).columns == ["carID", "price"]
    parts = df.withColumn("split", F.when(F.col("carID") == 1, "train").otherwise("validation"))
    files.write_split(parts, str(tmp_path / "parts"))
    assert {r["split"] for r in spark.read.parquet(str(tmp_path / "parts")).collect()} == {"train", "validation"}


def test_key_check(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    with pytest.raises(ValueError):
        files.check_key(df, "k")


def test_raw_file_recipe(spark):
    cols = "carID long, Brand string, model string, year double, price double, transmission string, mileage double, " \
           "fuelType string, tax double, mpg double, engineSize double, `paintQuality%` double, previousOwners double, hasDamage double"
    rows = [(1, "AUD", " A3 ", 2019.6, 1.0, "anual", -5.0, "etrol", 20.0, -1.0, 0.0, 101.0, 2.7, 0.0),
            (2, None, "a3", None, 1.0, "Unknown", 5.0, "electric", -1.0, 40.0, 2.0, 90.0, -1.0, None),
            (3, "bmw", "c clas", 2000.0, 1.0, "x", 5.0, None, None, 40.0, 2.0, 90.0, 1.0, None)]
    rules = cleaning.CleanRules(**cleaning.RAW_FILE_NAMES)
    out = {r["carID"]: r for r in cleaning.clean(spark.createDataFrame(rows, cols), rules).collect()}
    assert (out[1]["Brand"], out[1]["model"], out[1]["car_age"]) == ("Audi", "A3", 5)
    assert (out[1]["mileage"], out[1]["mpg"], out[1]["engineSize"], out[1]["paintQuality%"]) == (None,) * 4
    assert out[1]["previousOwners"] == 2 and out[1]["transmission"] == "Manual" and out[1]["fuelType"] == "Petrol"
    assert out[2]["Brand"] == "Audi" and out[2]["transmission"] == "Unknown" and out[2]["fuelType"] == "Electric"
    assert out[3]["model"] == "C class" and out[3]["transmission"] is None
    assert "hasDamage" not in out[1].asDict()


def test_profile_of_all_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "s string, x double")
    row = profile.describe_categorical(df, ["s"]).first()
    assert (row["count"], row["unique"], row["top"], row["freq"]) == (0, 0, None, None)
