"""Fixtures of the training-data operators."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
EXTRA = ("score double, kept boolean, _text string, _hash long, node long, size long, rank int, block long, "
         "component long, _row string, _gone long, label int, bucket long")


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog near the old stone bridge in spring "
    rows = [
        (1, prose * 6, "en", "a"), (1, prose * 6, "en", "a"), (2, prose * 6, "en", "b"), (3, None, "en", None),
        (4, "", None, "a"), (None, prose * 6, "en", "b"), (5, "   \n\t ", "fr", "c"), (6, "one", "en", "c"),
        (7, " ".join(f"w{i % 997}x{i}" for i in range(60_000)), "en", "a"), (8, "ένα δύο τρία 🙂 ñandú café " * 9, "es", "b"),
        (9, "token = abcdefgh12345678 mail me: a.b@c.org", "en", "b"), (None, None, None, None),
    ]
    fill = (0.5, True, "t", 1, 2, 3, 4, 5, 6, "r", 7, 1, 8)
    return spark.createDataFrame([(*r, len(r[1] or ""), *fill) for r in rows], f"{SCHEMA}, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
