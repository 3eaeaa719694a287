import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabloom.llm import kernel
from tabloom.llm.quality_rules import base_counts

WORD = re.compile("[^\x20\x09-\x0d]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t#🙂A", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 60))
def test_words_match_a_regular_expression(texts, block):
    before, kernel.BLOCK = kernel.BLOCK, block
    try:
        got = []
        for w in kernel.blocks(pa.array(texts, pa.string())):
            for t in range(w.n):
                at = np.flatnonzero(w.text == t)
                got.append([w.data[w.start[i]:w.end[i]].tobytes().decode() for i in at])
    finally:
        kernel.BLOCK = before
    assert got == [WORD.findall(t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_equal_hashes_mean_equal_words(texts):
    for w in kernel.blocks(pa.array(texts, pa.string())):
        words = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)]
        assert len(set(zip(words, w.hash.tolist()))) == len(set(words)) == len(set(w.hash.tolist()))


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_base_counts(texts):
    got = []
    for w in kernel.blocks(pa.array(texts, pa.string())):
        b = base_counts(w)
        got += list(zip(*[b[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]))
    want = []
    for t in texts:
        t = t or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
        want.append((len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)))
    assert got == want


@pytest.mark.parametrize("size", [1, 2, 3])
def test_grams_stay_inside_a_text(size):
    w = next(kernel.blocks(pa.array(["a b c d", "c d e", None, "x"])))
    _, at = w.grams(size)
    want = [i for t, n in enumerate([4, 3, 0, 1]) for i in range(max(n - size + 1, 0))]
    assert [int(i - np.searchsorted(w.text, w.text[i])) for i in at] == want
