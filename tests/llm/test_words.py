import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import odd_rows
from upkeep.llm.words import WORD, Words, parts


def spelled(texts):
    words = Words(pa.array(texts, pa.string()))
    return [
        [bytes(words.data[words.start[i] : words.end[i]]).decode() for i in range(words.first[t], words.first[t + 1])]
        for t in range(len(texts))
    ]


def pattern(text):
    return re.findall(WORD, pa.compute.utf8_lower(pa.scalar(text or "")).as_py())


def test_words_are_the_pattern():
    texts = [t for _, t in odd_rows()]
    assert spelled(texts) == [pattern(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_words_of_any_text(texts):
    assert spelled(texts) == [pattern(t) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    words = Words(pa.array(["alpha beta", "x alpha", "", "ALPHA"]))
    assert words.hashes[0] == words.hashes[3] == words.hashes[4]
    assert len(np.unique(words.hashes)) == 3


def test_shingles_do_not_cross_texts_and_short_texts_have_one():
    hashes, first = Words(pa.array(["a b c d e f", "a b", "", "b c d e f"])).shingles()
    assert np.diff(first).tolist() == [2, 1, 0, 1]
    assert hashes[1] == hashes[3]
    again, _ = Words(pa.array(["a b"])).shingles()
    assert again[0] == hashes[2]


def test_fingerprints_know_order():
    one = Words(pa.array(["a b c", "A  b, c!", "c b a", "a b"])).fingerprints()
    assert one[0] == one[1] and len(set(one.tolist())) == 3


def test_parts_cover_all_rows():
    batch = pa.record_batch({"text": pa.array(["x" * n for n in (5, 0, 100, 3, 3, 50)])})
    found = list(parts(batch, size=10))
    assert pa.Table.from_batches(found).column("text").to_pylist() == batch.column("text").to_pylist()
    assert len(found) > 2
