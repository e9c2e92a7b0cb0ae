"""Word and byte arithmetic against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesprep.llm import textnum

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aBé \n\t0x\x0b", max_size=40)), min_size=0, max_size=12)


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 50))
def test_words_and_shingles(texts, limit):
    rows, word_of, shingle_of = 0, {}, {}
    for lo, hi, buf, offs in textnum.slices(pa.array(texts, pa.string()), limit):
        starts, ends, before = textnum.word_bounds(buf, offs)
        hashes = textnum.word_hashes(buf, starts, ends)
        column = textnum.words_column(buf, starts, ends, np.arange(len(starts))).to_pylist()
        found, at = textnum.shingles(hashes, before)
        sets = list(textnum.row_sets(found, at))
        for r in range(hi - lo):
            words = plain_words(texts[lo + r])
            assert column[before[r] : before[r + 1]] == words
            for w, h in zip(words, hashes[before[r] : before[r + 1]].tolist(), strict=True):
                assert word_of.setdefault(w, h) == h
            runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
            for s, h in zip(runs, found[at[r] : at[r + 1]].tolist(), strict=True):
                assert shingle_of.setdefault(s, h) == h
            assert len(sets[r]) == len(set(runs))
        rows += hi - lo
    assert rows == len(texts)
    assert len(set(word_of.values())) == len(word_of) and len(set(shingle_of.values())) == len(shingle_of)


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=0, max_size=120), st.integers(1, 60))
def test_window_hashes(data, width):
    values = textnum.BYTE_VALUE[np.frombuffer(data, np.uint8)]
    got = textnum.window_hashes(values, width).tolist()
    assert len(got) == max(0, len(data) - width + 1)
    seen = {}
    for i, h in enumerate(got):
        assert seen.setdefault(data[i : i + width], h) == h
    assert len(set(seen.values())) == len(seen)
