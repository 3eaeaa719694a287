"""SQL building blocks of the reference results; each block is a common table expression."""

from __future__ import annotations

from tabloom.sources.cars import CARS_SQL

#: Doubles are compared after rounding; adding 0.0 turns -0.0 into 0.0.
DIGITS = 6


def r(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, {DIGITS}) + 0.0" + (f" AS {alias}" if alias else "")


def norm(c: str) -> str:
    stripped = f"regexp_replace(lower({c}), '^\\s+|\\s+$', '', 'g')"
    kept = f"regexp_replace({stripped}, '[^a-z0-9\\s\\-]', '', 'g')"
    return f"regexp_replace({kept}, '\\s+', ' ', 'g')"


def capitalized(c: str) -> str:
    return f"(upper(substring({c}, 1, 1)) || lower(substring({c}, 2)))"


def word_fixed(c: str) -> str:
    return f"regexp_replace({c}, '\\bclas\\b', 'class', 'g')"


def variants(names: str) -> str:
    """Spelling table of a subquery with one column `name`; excluded spellings are removed by the
    caller."""
    low = "lower(name)"
    return f"""SELECT DISTINCT s AS spelling, name AS canonical FROM (
      SELECT name, {low} AS s FROM ({names})
      UNION ALL SELECT name, substring({low}, 2) FROM ({names})
      UNION ALL SELECT name, substring({low}, 1, length({low}) - 1) FROM ({names})
      UNION ALL SELECT name, substring({low}, 2, length({low}) - 2) FROM ({names})) WHERE s <> ''"""


BRAND_NAMES = "SELECT lower(r_name) AS name FROM region"
FUEL_NAMES = "SELECT * FROM (VALUES ('Diesel'), ('Petrol'), ('Hybrid'), ('Other'), ('Electric')) t(name)"
GEAR_NAMES = (
    "SELECT * FROM (VALUES ('Manual'), ('Semi-Auto'), ('Automatic'), ('Unknown'), ('Other')) t(name)"
)

CTES = {
    "cars": CARS_SQL.format(orders="orders", customer="customer", nation="nation", region="region"),
    "brand_map": variants(BRAND_NAMES),
    "fuel_map": variants(FUEL_NAMES) + """ AND s NOT IN ('the')
      UNION ALL VALUES ('eletric', 'Electric'), ('letric', 'Electric'), ('eletri', 'Electric'), ('letri', 'Electric')""",
    "gear_map": variants(GEAR_NAMES) + " AND s NOT IN ('the', 'ther', 'othe')",
    "mapped": f"""
      SELECT car_id, bm.canonical AS brand, {capitalized(word_fixed(norm('c.model')))} AS model,
             CAST(2024 - floor(year) AS BIGINT) AS car_age, price,
             gm.canonical AS transmission, fm.canonical AS fuel_type,
             CASE WHEN mileage >= 0 THEN mileage END AS mileage,
             CASE WHEN tax >= 0 THEN tax END AS tax,
             CASE WHEN mpg >= 0 THEN mpg END AS mpg,
             CASE WHEN engine_size > 0 THEN engine_size END AS engine_size,
             CASE WHEN paint_quality <= 100 THEN paint_quality END AS paint_quality,
             CAST(floor(CASE WHEN previous_owners >= 0 THEN previous_owners END) AS BIGINT) AS previous_owners
      FROM cars c
      LEFT JOIN brand_map bm ON {norm('c.brand')} = bm.spelling
      LEFT JOIN fuel_map fm ON {norm('c.fuel_type')} = fm.spelling
      LEFT JOIN gear_map gm ON {norm('c.transmission')} = gm.spelling""",
    "inferred": """
      SELECT model, arg_min(brand, car_id) AS known FROM mapped
      WHERE model IS NOT NULL AND brand IS NOT NULL GROUP BY model""",
    "clean": """
      SELECT m.* REPLACE (coalesce(m.brand, i.known) AS brand)
      FROM mapped m LEFT JOIN inferred i ON m.model = i.model""",
    "branded": "SELECT * FROM clean WHERE brand IS NOT NULL",
    "strata": """
      SELECT brand, n, CAST(t.total - ceil(CAST(0.3 AS DOUBLE) * t.total) AS BIGINT) AS n_train, t.total
      FROM (SELECT brand, count(*) AS n FROM branded GROUP BY brand),
           (SELECT count(*) AS total FROM branded) t""",
    "shares": """
      SELECT brand, (n * n_train) // total AS base, n_train,
             row_number() OVER (ORDER BY (n * n_train) % total DESC, brand) AS place FROM strata""",
    "quota": """
      SELECT brand, base + CASE WHEN place <= n_train - (SELECT sum(base) FROM shares) THEN 1 ELSE 0 END AS take
      FROM shares""",
    "split_cars": """
      SELECT o.* EXCLUDE (place),
             CASE WHEN place <= q.take THEN 'train' ELSE 'validation' END AS split
      FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY (car_id * 7919) % 1000003, car_id) AS place
            FROM branded) o JOIN quota q USING (brand)""",
    "train": "SELECT * FROM split_cars WHERE split = 'train'",
}
_ORDER = list(CTES)
_NEEDS = {
    "cars": [], "brand_map": [], "fuel_map": [], "gear_map": [],
    "mapped": ["cars", "brand_map", "fuel_map", "gear_map"], "inferred": ["mapped"],
    "clean": ["inferred", "mapped"], "branded": ["clean"], "strata": ["branded"],
    "shares": ["strata"], "quota": ["shares"], "split_cars": ["branded", "quota"],
    "train": ["split_cars"],
}


def register_cte(name: str, sql: str, needs: list[str]) -> None:
    CTES[name] = sql
    _NEEDS[name] = needs
    _ORDER.append(name)


def mode_cte(source: str, group: str | None, c: str) -> str:
    """Most frequent value, the smallest on a tie."""
    keys = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""SELECT {keys}{c} AS mode FROM (
      SELECT {keys}{c}, row_number() OVER ({part}ORDER BY count(*) DESC, {c}) AS place
      FROM {source} WHERE {c} IS NOT NULL GROUP BY {keys}{c}) WHERE place = 1"""


def sql(body: str, *ctes: str, **extra: str) -> str:
    """Prefix `body` with the named blocks, what they need, and `extra` blocks after them."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for n in _NEEDS[name]:
                need(n)

    for c in ctes:
        need(c)
    parts = [f"{n} AS ({CTES[n]})" for n in _ORDER if n in needed]
    parts += [f"{n} AS ({text})" for n, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
