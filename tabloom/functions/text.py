"""Text cleaning as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_text(c: Column) -> Column:
    """Lower, strip both ends, drop all but a-z 0-9 whitespace hyphen, collapse whitespace.

    Stripping comes before dropping, so "a !" ends as "a ". `(?U)` makes whitespace Unicode-aware.
    Most names need no change, and one match is cheaper than three replacements.
    """
    low = F.lower(c)
    stripped = F.regexp_replace(low, r"(?U)^\s+|\s+$", "")
    kept = F.regexp_replace(stripped, r"(?U)[^a-z0-9\s\-]", "")
    full = F.regexp_replace(kept, r"(?U)\s+", " ")
    return F.when(low.rlike("^[a-z0-9-]+( [a-z0-9-]+)*$"), low).otherwise(full)


def replace_word(c: Column, word: str = "clas", replacement: str = "class") -> Column:
    """Replace `word` where it stands alone; `word` is plain letters and digits."""
    if not word.isalnum():
        raise ValueError("word must be letters and digits")
    return F.regexp_replace(c, rf"\b{word}\b", replacement)


def capitalize_first(c: Column) -> Column:
    """First character upper, all others lower (`initcap` would raise every word)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))
