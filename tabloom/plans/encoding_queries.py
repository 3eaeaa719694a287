"""Encoding and scaling queries: fitted on the train rows, applied to all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.operators import encode as E
from tabloom.operators import scale as S
from tabloom.plans import frames
from tabloom.plans.frames import CAR_BRANDS, rounded
from tabloom.plans.imputation_queries import known
from tabloom.plans.registry import query
from tabloom.plans.sqltext import r, sql
from tabloom.sources.cars import KEY, METRIC

FUELS = ["Diesel", "Electric", "Hybrid", "Other", "Petrol"]
GEARS = ["Automatic", "Manual", "Semi-Auto"]


def _train(df):
    return df.where(F.col("split") == "train")


def _flags(c: str, values: list[str], prefix: str, kind: str) -> str:
    return ", ".join(f"CAST(coalesce({c} = '{v}', FALSE) AS {kind}) AS \"{prefix}{v}\"" for v in values)


def _encoded(spark, sf, source, cols: list[str], **kw):
    rows = source(spark, sf).select(KEY, "split", "price", *cols)
    return E.Encoder(**kw).fit(_train(rows)).transform(rows).drop("split", "price")


@query("onehot_named", sql(f"SELECT car_id, {_flags('brand', CAR_BRANDS, '', 'DOUBLE')} FROM split_cars", "split_cars"))
def onehot_named(spark, sf):
    return _encoded(spark, sf, frames.split_cars, ["brand"], method="onehot_named", columns=["brand"],
                    handleUnknown="error")


@query("onehot_drop", sql(f"SELECT car_id, {_flags('fuel_type', [f for f in FUELS if f != 'Other'], '', 'DOUBLE')} "
                          "FROM split_cars", "split_cars"))
def onehot_drop(spark, sf):
    return _encoded(spark, sf, frames.split_cars, ["fuel_type"], method="onehot_named", columns=["fuel_type"],
                    leaveOut=["Other"])


@query("onehot_prefixed", sql(
    f"SELECT car_id, {_flags('fuel_type', FUELS, 'fuel_type_', 'INTEGER')}, "
    f"{_flags('transmission', GEARS, 'transmission_', 'INTEGER')} FROM known", "known"))
def onehot_prefixed(spark, sf):
    # Text columns are found by type.
    rows = known(spark, sf).select(KEY, "split", "fuel_type", "transmission")
    model = E.Encoder(method="onehot").fit(_train(rows).drop("split"))
    return model.transform(rows).drop("split")


_CODES = """SELECT brand, model, row_number() OVER (PARTITION BY brand ORDER BY model) - 1 AS code
    FROM (SELECT DISTINCT brand, model FROM train WHERE model IS NOT NULL)"""


def _coded(first: int, prefix: str) -> str:
    cols = ", ".join(
        f"CAST(CASE WHEN s.brand = '{b}' THEN coalesce(code + {first}, 0) ELSE 0 END AS BIGINT) AS \"{prefix}{b}\""
        for b in CAR_BRANDS)
    return sql(f"""SELECT car_id, {cols} FROM split_cars s
        LEFT JOIN codes c ON s.brand = c.brand AND s.model = c.model""", "split_cars", "train", codes=_CODES)


@query("label_in_group", _coded(0, ""))
def label_in_group(spark, sf):
    return _encoded(spark, sf, frames.split_cars, ["brand", "model"], method="label_in_group")


@query("hybrid_encode", _coded(1, "brand_"))
def hybrid_encode(spark, sf):
    return _encoded(spark, sf, frames.split_cars, ["brand", "model"], method="hybrid")


@query("encoding_map", sql("SELECT brand, model, code + 1 AS code FROM codes", "train", codes=_CODES))
def encoding_map(spark, sf):
    return E.Encoder(method="hybrid").fit(frames.train(spark, sf)).encoding_map()


_WORDS = ["model", "fuel_type", "transmission"]


def _target_sql(c: str) -> str:
    return r(f"coalesce(t_{c}.code, (SELECT avg(price) FROM train))", c)


@query("target_encode", sql(
    f"SELECT s.car_id, {', '.join(_target_sql(c) for c in _WORDS)} FROM known s "
    + " ".join(f"LEFT JOIN t_{c} ON s.{c} = t_{c}.{c}" for c in _WORDS), "known", "known_train", "train",
    **{f"t_{c}": f"SELECT {c}, avg(price) AS code FROM known_train WHERE {c} IS NOT NULL GROUP BY {c}" for c in _WORDS}))
def target_encode(spark, sf):
    return rounded(_encoded(spark, sf, known, _WORDS, method="target", columns=_WORDS, label="price"))


@query("freq_encode", sql(
    "SELECT s.car_id, " + ", ".join(r(f"coalesce(t_{c}.code, 0)", c) for c in _WORDS) + " FROM known s "
    + " ".join(f"LEFT JOIN t_{c} ON s.{c} = t_{c}.{c}" for c in _WORDS), "known", "known_train",
    **{f"t_{c}": f"SELECT {c}, count(*) / (SELECT count({c}) FROM known_train) AS code FROM known_train "
                 f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in _WORDS}))
def freq_encode(spark, sf):
    return rounded(_encoded(spark, sf, known, _WORDS, method="freq", columns=_WORDS))


@query("rare_group", sql(
    f"""SELECT s.car_id, CASE WHEN k.model IS NOT NULL THEN s.model WHEN s.model IS NOT NULL THEN 'other' END AS model
    FROM split_cars s LEFT JOIN k ON s.model = k.model""", "split_cars", "train",
    k="""SELECT model FROM train WHERE model IS NOT NULL GROUP BY model
         HAVING count(*) / (SELECT count(model) FROM train) >= 0.04"""))
def rare_group(spark, sf):
    rows = frames.split_cars(spark, sf)
    kept = E.frequent_values(_train(rows), ["model"], 0.04)
    return E.group_rare(rows.select(KEY, "model"), kept, ["model"])


# --- scaling ---


def _scaled(stats: dict[str, tuple[str, str]]) -> str:
    """(x - centre) / scale with both taken from the train rows, a zero scale being 1."""
    cols = ", ".join(r(f"(CAST(s.{c} AS DOUBLE) - (SELECT {m} FROM train)) / "
                       f"(SELECT CASE WHEN {d} = 0 THEN 1 ELSE {d} END FROM train)", c)
                     for c, (m, d) in stats.items())
    return sql(f"SELECT s.car_id, {cols} FROM split_cars s", "split_cars", "train")


def _q(c: str, p: float) -> str:
    return f"quantile_cont({c}, {p})"


def _stage(spark, sf, method: str):
    rows = frames.split_cars(spark, sf).select(KEY, "split", *METRIC)
    model = S.Scaler(method=method, columns=METRIC).fit(_train(rows))
    return model, rows


def _transformed(spark, sf, method: str):
    model, rows = _stage(spark, sf, method)
    return rounded(model.transform(rows).select(KEY, *METRIC))


@query("scale_robust", _scaled({c: (_q(c, 0.5), f"({_q(c, 0.75)} - {_q(c, 0.25)})") for c in METRIC}))
def scale_robust(spark, sf):
    return _transformed(spark, sf, "Robust")


@query("scale_minmax", _scaled({c: (f"min({c})", f"(max({c}) - min({c}))") for c in METRIC}))
def scale_minmax(spark, sf):
    return _transformed(spark, sf, "minmax")


@query("scale_standard", _scaled({c: (f"avg({c})", f"stddev_pop({c})") for c in METRIC}))
def scale_standard(spark, sf):
    return _transformed(spark, sf, "standard")


@query("scale_standard_group", sql(
    "SELECT s.car_id, s.brand, " + ", ".join(r(f"(s.{c} - g.m_{c}) / g.d_{c}", c) for c in METRIC)
    + " FROM split_cars s JOIN g ON s.brand = g.brand", "split_cars", "train",
    g="SELECT brand, " + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS d_{c}" for c in METRIC)
      + " FROM train GROUP BY brand"))
def scale_standard_group(spark, sf):
    rows = frames.split_cars(spark, sf)
    state = S.group_statistics(_train(rows), "brand", METRIC)
    overall = S.scale_statistics(_train(rows), METRIC, "standard")
    return rounded(S.scale_in_group(rows, state, "brand", METRIC, overall).select(KEY, "brand", *METRIC))


@query("scale_inverse", sql("SELECT car_id, " + ", ".join(r(f"CAST({c} AS DOUBLE)", c) for c in METRIC)
                            + " FROM split_cars", "split_cars"))
def scale_inverse(spark, sf):
    model, rows = _stage(spark, sf, "robust")
    return rounded(model.inverse(model.transform(rows)).select(KEY, *METRIC))


@query("scale_numeric_passthrough", sql(
    "SELECT s.car_id, s.brand, s.price, " + ", ".join(
        r(f"(CAST(s.{c} AS DOUBLE) - (SELECT min({c}) FROM train)) / (SELECT max({c}) - min({c}) FROM train)", c)
        for c in ["mileage", "tax"]) + " FROM split_cars s", "split_cars", "train"))
def scale_numeric_passthrough(spark, sf):
    rows = frames.split_cars(spark, sf).select(KEY, "brand", "price", "mileage", "tax", "split")
    model = S.Scaler(method="minmax").fit(_train(rows))
    return rounded(model.transform(rows).drop("split"))
