import inspect
import random
import re
from bisect import bisect_left

import numpy as np
import pytest

from tests.llm.data import CLASHES, documents, odd_rows, prose
from upkeep.llm import passages as P
from upkeep.llm import suffixes as S
from upkeep.llm.spans import cut, merged
from upkeep.llm.words import WORD, mix


def corpus():
    """Shared passages of many lengths, common lines, copies, and documents of their own."""
    rng = random.Random(1)
    shared = [prose(1000 + i, n) for i, n in enumerate((45, 49, 50, 51, 60, 90, 200))]
    line = prose(2000, 20)
    rows = []
    for i in range(80):
        parts = [prose(i, rng.randint(10, 120))]
        for _ in range(rng.randint(0, 3)):
            parts.append(rng.choice([*shared, line, line]))
            parts.append(prose(5000 + 10 * i + len(parts), rng.randint(0, 80)))
        rows.append((i, "\n".join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 12, 4)]
    return rows


def repeated_words(rows, size=50):
    """Per document the words that lie in a run of ``size`` that another document has."""
    at = {}
    for doc, text in rows:
        words = re.findall(WORD, (text or "").lower())
        for k in range(len(words) - size + 1):
            at.setdefault(tuple(words[k : k + size]), set()).add((doc, k))
    out = {}
    for places in at.values():
        if len({d for d, _ in places}) > 1:
            for doc, k in places:
                out.setdefault(doc, set()).update(range(k, k + size))
    return out


def test_sliding_min():
    values = np.random.default_rng(0).integers(0, 1000, 300).astype(np.uint64)
    for width in (1, 2, 3, 26, 46, 64):
        assert P.sliding_min(values, width).tolist() == [values[i : i + width].min() for i in range(300 - width + 1)]


def test_windows_cover_every_start_with_its_smallest_hashes():
    rng = np.random.default_rng(1)
    hashes = mix(rng.integers(0, 50, 700).astype(np.uint64))
    first = np.array([0, 300, 300, 340, 700])
    text, keys, place = P.windows(hashes, first)
    start, size, least, band = P.unpacked(place)
    seen = {}
    for t, k, s, n, c, b in zip(text, keys, start, size, least, band):
        for p in range(s, s + n):
            assert (t, p, b) not in seen
            seen[t, p, b] = k
        own = mix(hashes[first[t] + s : first[t] + s + P.LENGTH], 20 + 2 * b) >> np.uint64(22)
        assert own[c - s] == own.min()
    count = np.maximum(0, np.diff(first) - P.LENGTH + 1).sum()
    assert len(seen) == P.BANDS * count
    by_minima = {}
    for (t, p, b), k in seen.items():
        part = hashes[first[t] + p : first[t] + p + P.LENGTH]
        minima = tuple(int((mix(part, 20 + 2 * b + j) >> np.uint64(22)).min()) for j in range(2))
        assert by_minima.setdefault((b, minima), k) == k


def test_a_very_long_run_is_split():
    hashes = np.full(10_000, 7, np.uint64)
    _, _, place = P.windows(hashes, np.array([0, 10_000]), bands=1)
    _, size, _, _ = P.unpacked(place)
    assert len(size) == 3 and size.sum() == 10_000 - P.LENGTH + 1


def test_no_exact_repeat_is_missed(spark):
    rows = corpus()
    want = repeated_words(rows)
    found = {}
    texts = dict(rows)
    for r in P.passages(documents(spark, rows)).collect():
        spans = [(m.start(), m.end()) for m in re.finditer(WORD, texts[r.doc_id].lower())]
        found.setdefault(r.doc_id, set()).update(k for k, (a, b) in enumerate(spans) if r.start <= a and b <= r.end)
        assert (r.other < r.doc_id) == (r.role == "copy")
    for doc, words in want.items():
        assert words <= found[doc]
    clean = {d for d, _ in rows} - set(want)
    assert clean and not clean & set(found)


def test_contexts_are_shared_by_equal_passages():
    rng = np.random.default_rng(7)
    for size in (P.LENGTH, P.LENGTH + 1, 80):
        shared = rng.integers(0, 1 << 60, size).astype(np.uint64)
        sides = [rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (0, 30, 61, 0)]
        hashes = np.concatenate((sides[0], shared, sides[1], sides[2], shared, sides[3]))
        first = np.array([0, 0, size + 30, size + 30 + 61 + size])
        text, keys, place = P.contexts(hashes, first)
        start, runs, least, band = P.unpacked(place)
        assert set(text) == {1, 2} and set(band) == {P.BANDS, P.BANDS + 1}
        at = {t: {k: c for k, c in zip(keys[text == t], least[text == t])} for t in (1, 2)}
        both = at[1].keys() & at[2].keys()
        assert both and all(at[2][k] - at[1][k] == 61 for k in both)
        covered = np.concatenate([np.arange(s, s + n) for s, n, t in zip(start, runs, text) if t == 1])
        assert set(covered) == set(range(size + 30 - P.LENGTH + 1))
    none = P.contexts(np.zeros(5, np.uint64), np.array([0, 5]))
    assert [len(x) for x in none] == [0, 0, 0]


@pytest.mark.parametrize("variants", [20, 300])
def test_repeats_are_found_within_a_family_that_only_resembles_them(spark, variants):
    """Before the last two documents of a family come texts with a quarter of its words replaced."""
    rng, rows, wanted = random.Random(11), [], set()
    for family in range(10):
        shared = prose(9000 + family, 60).split()
        for i in range(variants):
            other = [prose(rng.randrange(10**9), 1) if rng.random() < 0.25 else w for w in shared]
            rows.append((1000 * family + i, f"{prose(rng.randrange(10**9), 20)} {' '.join(other)}"))
        for i in (900, 901):
            rows.append((1000 * family + i, f"{prose(rng.randrange(10**9), 30)} {' '.join(shared)} {prose(rng.randrange(10**9), 30)}"))
            wanted.add((1000 * family + i, "copy" if i == 901 else "source"))
    found = {(r.doc_id, r.role) for r in P.passages(documents(spark, rows)).collect()}
    assert wanted <= found


def test_near_passages_are_found_and_far_ones_are_not(spark):
    rng = random.Random(9)
    rows, near = [], {}
    for i in range(40):
        shared = prose(100 + i, 80).split()
        other = list(shared)
        far = i % 2
        for _ in range(30 if far else 2):
            other[rng.randrange(80)] = "qq"
        rows.append((2 * i, f"{prose(300 + i, 40)} {' '.join(shared)} {prose(400 + i, 40)}"))
        rows.append((2 * i + 1, f"{prose(500 + i, 30)} {' '.join(other)} {prose(600 + i, 60)}"))
        near[2 * i] = near[2 * i + 1] = not far
    found = {r.doc_id for r in P.passages(documents(spark, rows)).collect()}
    assert not {i for i, yes in near.items() if not yes} & found
    # Two changed words put some of these just at the threshold, where hashes may miss.
    assert len(found) >= 0.9 * sum(near.values())


@pytest.mark.parametrize("words,inserted", [(60, 2), (60, 4), (120, 9), (400, 60)])
def test_passages_of_unequal_length_match_by_their_similarity(words, inserted):
    rng = np.random.default_rng(words)
    shared = rng.integers(1, 1 << 60, words - 4).astype(np.uint64)
    half = words // 2
    new = rng.integers(1, 1 << 60, inserted + 4).astype(np.uint64)
    other = np.concatenate((shared[: half - 4], new, shared[half:]))
    around = [rng.integers(1, 1 << 60, 70).astype(np.uint64) for _ in range(4)]
    a, b = np.concatenate((around[0], shared, around[1])), np.concatenate((around[2], other, around[3]))
    kept = words - 8
    assert kept / (len(shared) + len(other) - kept) >= P.SIMILARITY
    found = P.matched_spans(a, b, [(0, 70, 70), (inserted, 70 + half, 70 + half)])
    assert found == ([(70, 69 + len(shared))], [(70, 69 + len(other))])


def test_alike_is_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a = rng.integers(0, 1 << 60, 90).astype(np.uint64)
        b = np.where(rng.random(90) < 0.12, np.uint64(1), a)
        at = int(rng.integers(30, 60))
        b = np.concatenate((b[:at], np.full(int(rng.integers(0, 9)), 2, np.uint64), b[at:]))
        i, j = np.nonzero(a[:, None] == b)
        want = set()
        for x in range(len(i)):
            for y in range(x, len(i)):
                la, lb, n = i[y] - i[x] + 1, j[y] - j[x] + 1, y - x + 1
                if min(la, lb) >= P.LENGTH and n / (la + lb - n) >= P.SIMILARITY:
                    want.update(range(i[x], i[y] + 1))
        assert {k for x in P.alike(a, b, np.arange(-9, 10)) for k in range(x[0], x[1] + 1)} == want


def test_suffixes_find_exactly_the_repeats(spark):
    rows = corpus()
    found = {}
    for r in S.repeats(documents(spark, rows)).collect():
        found.setdefault(r.doc_id, set()).update(range(r.start, r.end))
        assert (r.other < r.doc_id) == (r.role == "copy")
    assert found == repeated_words(rows)


def roles_by_brute_force(rows, size=50):
    """Per document and role the words in runs of ``size`` that a smaller (larger) document has."""
    at = {}
    for doc, text in rows:
        words = re.findall(WORD, text.lower())
        for k in range(len(words) - size + 1):
            at.setdefault(tuple(words[k : k + size]), set()).add((doc, k))
    out = {}
    for places in at.values():
        low, high = min(places)[0], max(places)[0]
        for doc, k in places:
            for role in ["copy"] * (doc > low) + ["source"] * (doc < high):
                out.setdefault((doc, role), set()).update(range(k, k + size))
    return out


def recombined():
    """A passage of 60 words in many surroundings, and a block between recombined headers and footers."""
    passage, block = prose(7000, 60), prose(7001, 27)
    heads, tails = [[prose(7100 + 100 * j + i, 40) for i in range(4)] for j in range(2)]
    rows = [(i, f"{prose(7300 + i, 40)} {passage} {prose(7400 + i, 40)}") for i in range(60)]
    rng = random.Random(3)
    for i in range(60):
        head, tail = rng.choice(heads).split()[-rng.randint(5, 20) :], rng.choice(tails).split()[: rng.randint(5, 20)]
        rows.append((100 + i, " ".join([prose(7500 + i, 40), *head, block, *tail, prose(7600 + i, 40)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [corpus(), recombined()])
def test_suffixes_give_every_later_copy_its_role(spark, rows):
    found = {}
    for r in S.repeats(documents(spark, rows)).collect():
        found.setdefault((r.doc_id, r.role), set()).update(range(r.start, r.end))
    assert found == roles_by_brute_force(rows)


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_suffixes_meet_across_partitions(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        test_suffixes_find_exactly_the_repeats(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


@pytest.mark.parametrize("operator", [P.passages, S.repeats])
def test_odd_rows(spark, operator):
    found = operator(documents(spark, odd_rows(), CLASHES)).collect()
    assert {(r.doc_id, r.role, r.other) for r in found} == {(7, "source", 8), (8, "copy", 7), (9, "source", 10), (10, "copy", 9)}
    assert operator(documents(spark, [])).collect() == []


def test_merged(spark):
    spans = [(1, "copy", 0, 10, 5), (1, "copy", 5, 20, 4), (1, "copy", 30, 40, 9), (1, "source", 8, 9, 7), (1, "copy", 0, 10, 3)]
    got = merged(spark.createDataFrame(spans, "doc_id long, role string, start long, end long, other long"))
    assert sorted(map(tuple, got.select("doc_id", "role", "start", "end", "other").collect())) == [
        (1, "copy", 0, 20, 3),
        (1, "copy", 30, 40, 9),
        (1, "source", 8, 9, 7),
    ]


def test_cut(spark):
    docs = documents(spark, [(1, "abc défg hij"), (2, "gone"), (3, None), (None, "x"), (4, "stay")], CLASHES)
    spans = spark.createDataFrame([(1, 4, 8), (1, 0, 1), (2, 0, 4)], "doc_id long, start long, end long")
    got = cut(docs, spans)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.n_chars, r.cuts) for r in got.collect()) == [
        (0, "x", 1, "cuts!"),
        (1, "bc  hij", 7, "cuts!"),
        (3, None, None, "cuts!"),
        (4, "stay", 4, "cuts!"),
    ]


def test_links_are_sent_in_bounded_batches():
    """An executor holds what a worker sends at once, so no batch has all links of a million windows."""
    rng = np.random.default_rng(3)
    n = 3 * P.SENT
    doc, keys, place = rng.integers(0, 500, n), rng.integers(0, n // 4, n).astype(np.uint64), rng.permutation(n)
    order = np.lexsort((place, doc, keys))
    a, b, own = P.star(keys[order], doc[order], place[order])
    found = [(doc[i : i + 10_000], keys[i : i + 10_000], place[i : i + 10_000]) for i in range(0, n, 10_000)]
    sent = list(P.first_links(found))
    assert not found and len(sent) > 2 and max(x.num_rows for x in sent) <= P.SENT
    rows = [r for x in sent for r in zip(*(x.column(c).to_pylist() for c in ("a", "at_a", "b", "at_b")))]
    doc, place = doc[order].tolist(), place[order].tolist()
    assert [r for r in rows if r[2] is None] == [(doc[i], place[i], None, None) for i in np.flatnonzero(own)]
    assert [r for r in rows if r[2] is not None] == [(doc[i], place[i], doc[j], place[j]) for i, j in zip(a.tolist(), b.tolist())]
    slots = [s for x in sent if x.column("b").null_count for s in x.column("slot").to_pylist()]
    assert slots == keys[order][own].view(np.int64).tolist()


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    from upkeep.llm import store

    given = []
    monkeypatch.setattr(store, "give_back", lambda: given.append(1))

    def run(batches: list) -> list:
        yield from batches

    whole = store.returning(run)
    assert list(whole([1, 2])) == [1, 2] and given == [1]
    broken = whole([1, 2])
    assert next(broken) == 1
    broken.close()
    assert given == [1, 1]
    assert inspect.signature(whole) == inspect.signature(run)
    monkeypatch.undo()
    store.give_back()


def longest_forward(at_a, at_b):
    """Value by value: each is put after the last one that ends a sequence one shorter."""
    ends, before = [], []
    for i, b in enumerate(at_b):
        k = next((k for k, e in enumerate(ends) if at_b[e] >= b), len(ends))
        before.append(ends[k - 1] if k else -1)
        ends[k : k + 1] = [i]
    i, out = ends[-1], []
    while i >= 0:
        out.append((at_a[i], at_b[i]))
        i = before[i]
    return out[::-1]


def test_chain_is_the_one_found_place_by_place():
    rng = np.random.default_rng(3)
    for n, span in ((1, 1), (6, 4), (40, 12), (200, 60), (200, 9)):
        for _ in range(20):
            places = np.unique(np.stack((rng.integers(0, span, n), rng.integers(0, span, n)), 1), axis=0)
            at_a, at_b = P.together([tuple(x.T) for x in np.array_split(places, min(3, len(places)))])
            assert sorted(zip(at_a, -at_b)) == list(zip(at_a, -at_b)) and len(at_a) == len(places)
            assert list(zip(*P.chain(at_a, at_b))) == longest_forward(at_a.tolist(), at_b.tolist())


def test_shared_places_are_all_of_them(monkeypatch):
    rng = np.random.default_rng(4)
    for compared in (1 << 20, 40, 1):
        monkeypatch.setattr(P, "COMPARED", compared)
        for n, m in ((1, 1), (30, 90), (90, 30), (70, 70)):
            a, b = (mix(rng.integers(0, 9, k).astype(np.uint64)) for k in (n, m))
            a[0] = b[-1] = 0  # what the ends are padded with
            shifts = np.unique(np.concatenate([c + np.arange(-8, 9) for c in (-100, -60, 3, 6, 85)]))
            got = P.shared(a, b, shifts)
            want = {(i, i + s) for s in shifts.tolist() for i in range(n) if 0 <= i + s < m and a[i] == b[i + s]}
            assert {x for group in got for x in zip(*(p.tolist() for p in group))} == want
            assert sum(len(x) for x, _ in got) == len(want)


def test_settled_texts_are_not_searched(monkeypatch):
    """Words that repeat make places that cross; within a span that is found already,
    and apart from all others, no sequence through them is looked for."""
    searched = []
    monkeypatch.setattr(P, "bisect_left", lambda ends, b: searched.append(b) or bisect_left(ends, b))
    rng = np.random.default_rng(5)

    def own(n):
        return mix(rng.integers(0, 1 << 60, n).astype(np.uint64))

    line, one, two = own(3), own(80), own(90)
    block = np.concatenate((one, np.tile(line, 8), two))
    a = np.concatenate((own(60), block, own(400), two))
    b = np.concatenate((own(70), block, own(900), two))
    at = 60 + len(block) + 400, 70 + len(block) + 900
    found = [(10, 60, 70), (at[1] - at[0], at[0], at[0] + 1)]
    spans = P.matched_spans(a, b, found)
    assert not searched
    assert spans == tuple([(x, x + len(block) - 1), (y, y + 89)] for x, y in ((60, at[0]), (70, at[1])))
    # Two spans that a passage over both could join are still searched as one.
    a, b = np.concatenate((one, two)), np.concatenate((one, own(20), two))
    assert P.matched_spans(a, b, [(0, 0, 1), (20, 80, 81)]) == ([(0, 169)], [(0, 189)])


def test_order_of_windows_is_by_key_document_and_place():
    rng = np.random.default_rng(6)
    for n, keys in ((0, 1), (1, 1), (500, 3), (500, 400), (500, 1 << 40)):
        k, d, q = rng.integers(0, keys, n).astype(np.uint64), rng.integers(-5, 5, n), rng.integers(0, 4, n)
        order = P.order_of(k, d, q)
        assert sorted(order.tolist()) == list(range(n))
        assert list(zip(k[order], d[order], q[order])) == sorted(zip(k, d, q))
