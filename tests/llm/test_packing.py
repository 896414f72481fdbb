import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.data import CLASHES, documents, odd_rows
from upkeep.llm import tokens
from upkeep.llm.packing import Sums, best_fit, exact_then_best_fit, lower_bound, pack, pieces_of, plan
from upkeep.llm.tokens import tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def used(patterns, size):
    out = Counter()
    for content, times in patterns:
        assert times > 0 and sum(content) <= size
        for n in content:
            out[n] += times
    return out


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=30))
def test_plan_uses_every_piece_once(counts):
    found = plan(counts, 64)
    assert used(found, 64) == Counter(counts)
    assert lower_bound(counts, 64) <= sum(t for _, t in found) <= sum(t for _, t in best_fit(Counter(counts), 64))


def test_exact_complements():
    assert exact_then_best_fit({700: 2, 324: 2}, 1024) == ([((700, 324), 2)], 0)
    assert exact_then_best_fit({700: 3, 200: 3, 124: 3}, 1024) == ([((700, 200, 124), 3)], 3)
    assert exact_then_best_fit({600: 1, 300: 1, 100: 1, 24: 1}, 1024) == ([((600, 300, 100, 24), 1)], 1)
    assert exact_then_best_fit({700: 1, 200: 1, 124: 1}, 1024, 125)[1] == 0
    assert exact_then_best_fit({512: 4}, 1024) == ([((512, 512), 2)], 0)
    assert plan({1024: 5}, 1024) == [((1024,), 5)]
    assert plan({}, 1024) == []


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), max_size=12), st.integers(2, 40), st.data())
def test_sums_find_what_there_is(counts, total, data):
    """Also after lengths were spent between the lookups."""
    left = Counter(counts)
    sums = Sums(left, 0, 0)
    for _ in range(6):
        pairs = [(a, b) for b in left for a in left if a + b == total and a >= b and not Counter((a, b)) - left]
        triples = [(a, b, c) for c in left for b in left for a in [total - b - c] if a >= b >= c and not Counter((a, b, c)) - left]
        pair, triple = sums.pair(total, 0), sums.triple(total)
        assert pair == (max(pairs, key=lambda p: p[1]) if pairs else None)
        assert (triple in triples and triple[2] == max(t[2] for t in triples)) if triples else triple is None
        some = [n for n in left if left[n] > 0]
        if some:
            left[data.draw(st.sampled_from(some))] -= 1


def test_plan_of_real_lengths_uses_pairs_and_triples():
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    counts = Counter()
    for e in tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False):
        counts[len(e.ids) % 1024 + 1] += 1
        counts[1024] += len(e.ids) // 1024
    for times in (1, 97):
        many = Counter({n: c * times for n, c in counts.items()})
        found = plan(many, 1024)
        assert used(found, 1024) == many
        needed, plain = sum(t for _, t in found), sum(t for _, t in best_fit(Counter(many), 1024))
        assert needed <= plain and (times == 1 or needed < plain)
        full = Counter()
        for content, t in found:
            full[len(content)] += t * (sum(content) == 1024)
        assert full[3] > 0 and full[4] > 0


def test_pack_odd_rows(spark):
    rows = odd_rows()
    got = pack(documents(spark, rows, CLASHES), PATH, 2, 1024).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer(PATH).encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        head = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == sum(t for _, t in plan(Counter(r.length for r in got), 1024))


def test_pack_over_several_parts(spark):
    from upkeep.llm.packing import assign, pieces_of
    from upkeep.llm.store import Kept

    kept = Kept(spark)
    docs = documents(spark, [(i, "w " * (1 + i * 37 % 90)) for i in range(300)])
    pieces = kept.keep(pieces_of(docs, PATH, 2, 64), "pieces")
    got = assign(pieces, kept, 64, per_part=50).collect()
    assert len(got) == pieces.count()
    places = {(r.sequence_id, r.offset) for r in got}
    assert len(places) == len(got)
    total = Counter()
    for r in got:
        total[r.sequence_id] += r.length
    assert max(total.values()) <= 64
    assert len(total) == sum(t for _, t in plan(Counter(r.length for r in got), 64))


def test_pack_no_rows(spark):
    assert pack(documents(spark, []), PATH).collect() == []


def test_a_task_forgets_its_units(spark):
    """Workers stay for later tasks, where units and tokenizers would count in the executor's memory."""

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words and some more", None]})
    found = pa.Table.from_batches(pieces_of(Docs(), PATH, 2, 1024)(iter([rows]))).to_pylist()
    assert [(r["doc_id"], r["piece"], r["start"]) for r in found] == [(1, 0, 0), (2, 0, 0)] and found[1]["length"] == 1
    assert not tokens._KNOWN and not tokens.tokenizer.cache_info().currsize
