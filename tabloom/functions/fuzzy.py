"""Similarity of two short names and the signatures that find candidates for it."""

from __future__ import annotations

import math
from itertools import combinations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed order from rare to common; any order gives complete candidates, this one gives few.
_RARE_FIRST = "zqjxkvbywgpfmucdlhrsnioate9876543210- "
_RANK = {ch: i for i, ch in enumerate(_RARE_FIRST)}


def sorted_tokens(c: Column) -> Column:
    """Words in order, joined by one space."""
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit per letter of `a` (Hyyro 2004)."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for ch in b:
        hit = state & places.get(ch, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * LCS / total length; two empty names are equal."""
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def ratio_of(a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def scores(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([ratio(x, y) for x, y in zip(left, right)], dtype="float64")

    return scores(a, b)


def signatures(name: str, least: float) -> list[str]:
    """Keys such that two names scoring `least` or more share at least one.

    A score of 100 s needs a partner of at least len * s / (2 - s) letters and as many letters in
    common. Letters are told apart by occurrence and put in one fixed order; names with that
    overlap share two of the first len - overlap + 2 (prefix filtering, Chaudhuri et al. 2006;
    two-letter form, Wang et al. 2012), so each pair of those letters is a key.
    """
    if len(name) < 2:
        return ["=" + name]
    share = least / 100.0
    overlap = math.ceil(len(name) * share / (2 - share) - 1e-9)
    seen: dict[str, int] = {}
    letters = []
    for ch in name:
        seen[ch] = seen.get(ch, 0) + 1
        letters.append((-seen[ch], _RANK.get(ch, -1), ch))
    letters.sort()
    # A one-letter overlap cannot fill a pair, so such a name keeps single letters as well.
    head = [f"{ch}{-n}" for n, _, ch in letters[: len(name) - overlap + 2]]
    keys = [x + y for x, y in combinations(head, 2)]
    return keys if overlap >= 2 else keys + head


def signatures_of(c: Column, least: float) -> Column:
    @F.pandas_udf("array<string>")
    def keys(names: pd.Series) -> pd.Series:
        return names.map(lambda n: signatures(n, least))

    return keys(c)
