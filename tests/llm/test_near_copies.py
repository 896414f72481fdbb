import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import CLASHES, documents, odd_rows, prose
from upkeep.llm import near_copies as N
from upkeep.llm.components import components
from upkeep.llm.store import Kept
from upkeep.llm.words import WORD, Words, mix


def shingles(text):
    words = re.findall(WORD, (text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def classes(rows, least=0.8):
    """By comparing all pairs."""
    ids = sorted({i for i, _ in rows if i is not None})
    text = dict(rows)
    root = {i: i for i in ids}

    def find(i):
        return i if root[i] == i else find(root[i])

    for x in ids:
        for y in ids:
            if x < y and similarity(text[x], text[y]) >= least:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(rng.choice(["zig", "zag", "zog"]) if rng.random() < share else w for w in text.split())


def test_signatures_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(40):
        n = int(rng.integers(3, 300))
        element = mix(rng.integers(0, 1 << 60, n).astype(np.uint64))
        a = rng.geometric(0.5, n)
        b = np.where(rng.random(n) < 0.3, rng.integers(1, 9, n), a)
        found = N.signatures(np.repeat([0, 1], n), np.tile(element, 2), np.concatenate((a, b)), 2, 512)
        errors.append((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_signatures_of_empty_and_heavy_sets():
    found = N.signatures(np.array([1, 1]), np.array([5, 9], np.uint64), np.array([1, 10_000]), 3)
    assert (found[0] == N.NONE).all() and (found[2] == N.NONE).all()
    assert (found[1] != N.NONE).all()


def test_exact_similarity():
    a = [prose(1, 80), "", "one two", "w " * 50, prose(1, 80)]
    b = [edited(prose(1, 80), 1, 0.05), "", "one two", "w " * 40, prose(2, 80)]
    got = N.similarity(Words(pa.array(a)), Words(pa.array(b)))
    assert np.allclose(got, [similarity(x, y) for x, y in zip(a, b)])


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2500)]
    edges += [(7, 7), (8, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long"), Kept(spark)).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root}
    assert len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long"), Kept(spark)).collect() == []


def test_classes_are_those_of_all_pairs(spark):
    rows = []
    for k in range(25):
        base = prose(k, 60 + 4 * k)
        rows.append((10 * k, base))
        rows += [(10 * k + j, edited(base, 100 * k + j, 0.005 * j)) for j in range(1, 8)]
    rows += [(900 + i, rows[i][1].upper()) for i in range(0, 40, 3)]
    got = {r.doc_id: r.class_id for r in N.near_copies(documents(spark, rows)).collect()}
    assert got == classes(rows)


def test_a_large_group_is_compared_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    base = prose(3, 100)
    rows = [(i, edited(base, i, 0.03)) for i in range(60)]
    got = {r.doc_id: r.class_id for r in N.near_copies(documents(spark, rows)).collect()}
    want = classes(rows)
    assert 1 < len(set(want.values())) < 60
    assert got == want


def test_odd_rows(spark):
    rows = odd_rows()
    got = N.near_copies(documents(spark, rows, CLASHES)).collect()
    assert sorted(r.doc_id or 0 for r in got) == sorted(i or 0 for i, _ in rows)
    named = {r.doc_id: (r.class_id, r.class_size) for r in got if r.doc_id is not None}
    assert named[7] == named[8] == (7, 2)
    assert named[9] == named[10] == (9, 3)
    for alone in (1, 2, 3, 4, 5, 6, 11, 12, 13, 14):
        assert named[alone] == (alone, 1)
    assert all((r.class_id, r.class_size) == (None, 1) for r in got if r.doc_id is None)


def test_no_rows(spark):
    assert N.near_copies(documents(spark, [])).collect() == []


def test_other_thresholds(spark):
    base = prose(8, 150)
    rows = [(i, edited(base, i, 0.01 * i)) for i in range(6)]
    got = {r.doc_id: r.class_id for r in N.near_copies(documents(spark, rows), 0.9).collect()}
    assert got == classes(rows, 0.9)
    with pytest.raises(ValueError):
        N.near_copies(documents(spark, rows), 0.5)
