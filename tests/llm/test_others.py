import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from tests.llm.data import CLASHES, documents, odd_rows, prose
from upkeep.llm import fingerprints as P
from upkeep.llm import language as L
from upkeep.llm import shards as S
from upkeep.llm import vectors as V

# Shards


def test_fisher_yates_is_a_fair_permutation():
    assert sorted(S.fisher_yates(1000, 7)) == list(range(1000))
    assert S.fisher_yates(50, 1).tolist() == S.fisher_yates(50, 1).tolist()
    assert S.fisher_yates(0, 1).tolist() == []
    seen = Counter(tuple(S.fisher_yates(3, seed)) for seed in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400


@pytest.mark.parametrize("bucket_bytes", [400, 1 << 20])
def test_shards_hold_every_row_once(spark, tmp_path, bucket_bytes):
    docs = documents(spark, [(i, prose(i, 1 + i % 30)) for i in range(203)] + odd_rows(), CLASHES)
    stored = S.write_shards(docs, f"file://{tmp_path}/shards", 16, bucket_bytes=bucket_bytes)
    rows = stored.collect()
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    assert Counter(str([r[c] for c in names]) for r in rows) == Counter(str([r[c] for c in names]) for r in docs.collect())
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 16
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_shards_do_not_depend_on_the_order_of_rows(spark):
    rows = [(i, prose(i, 5)) for i in range(100)]
    one = {r.doc_id: (r.shard, r.slot) for r in S.sharding(documents(spark, rows)).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in S.sharding(documents(spark, rows[::-1]).repartition(5)).collect()}
    assert one == two
    order = [i for i, _ in sorted(one.items(), key=lambda x: x[1])]
    assert order != sorted(order)


def test_sharding_describes_rows(spark):
    got = S.sharding(documents(spark, odd_rows(), CLASHES)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "rows", None) for i, t in odd_rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in got) == want
    assert S.sharding(documents(spark, [])).collect() == []


# Fingerprints


def brute_print(text):
    from upkeep.llm.words import Words, mix

    hashes, _ = Words(pa.array([text or ""])).shingles(3)
    out = ""
    for half in range(P.BITS // 64):
        raw = b"".join(int(h).to_bytes(8, "little") for h in mix(hashes, 90 + half))
        votes = [0] * 64
        for i in range(0, len(raw), 8):
            for k, bit in enumerate("".join(f"{byte:08b}" for byte in raw[i : i + 8])):
                votes[k] += 1 if bit == "1" else -1
        out += "".join("1" if v > 0 else "0" for v in votes)
    return f"{int(out, 2):0{P.BITS // 4}x}"


@pytest.mark.parametrize("per_range", [2, 4096])
def test_edited_fingerprints(spark, monkeypatch, per_range):
    plain = P.with_next
    monkeypatch.setattr(P, "with_next", lambda docs: plain(docs, per_range))
    rows = odd_rows()
    got = P.edited_fingerprints(documents(spark, rows, CLASHES)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = Counter()
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        prints = [brute_print(t) for t in (text, edited, after)]
        near = [1.0 if p == prints[0] else max(0.0, math.cos(math.pi * (int(p, 16) ^ int(prints[0], 16)).bit_count() / P.BITS)) for p in prints]
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[0], prints[1], round(near[1], 9), round(near[2], 9)] += 1
    assert Counter((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want


def test_edited_fingerprints_of_few_rows(spark):
    assert P.edited_fingerprints(documents(spark, [])).collect() == []
    one = P.edited_fingerprints(documents(spark, [(5, "abcdefgh")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0


@pytest.mark.parametrize(("count", "radius"), [(10, 3), (10**5, 6), (10**9, 6), (10**11, 6)])
def test_tables_find_all_within_the_radius(count, radius):
    tables = P.table_keys(count, radius)
    rng = random.Random(count)
    for _ in range(200):
        apart = set(rng.sample(range(P.BITS), radius))
        assert any(all(not apart & set(range(a, a + n)) for a, n in chosen) for chosen in tables)


@pytest.mark.parametrize("block", [5, 1000])
def test_print_classes(spark, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(4)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(P.BITS)
        for _ in range(9):
            for bit in rng.sample(range(P.BITS), rng.randint(0, 5)):
                base ^= 1 << bit
            prints.append(f"{base:032x}")
    prints += [prints[0], None]
    rows = [(p,) for p in prints]
    got = {r.print: r["class"] for r in P.print_classes(spark.createDataFrame(rows, "print string"), 3).collect()}
    known = sorted({p for p in prints if p})
    root = {p: p for p in known}

    def find(p):
        return p if root[p] == p else find(root[p])

    for a in known:
        for b in known:
            if a < b and (int(a, 16) ^ int(b, 16)).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert got == {p: find(p) for p in known}


def test_fingerprint_classes_name_documents(spark):
    rows = [(5, prose(1, 200)), (3, prose(1, 200)), (9, prose(2, 200)), (4, None), (6, "")]
    got = {r.doc_id: r.class_id for r in P.fingerprint_classes(P.edited_fingerprints(documents(spark, rows))).collect()}
    assert got == {5: 3, 3: 3, 9: 9, 4: 4, 6: 4}


# Language

ALPHABETS = {"aa": "abcdefgh", "bb": "ghijklmn", "cc": "mnopqrst", "dd": "rstuvwxé"}


def labelled(n, seed=0):
    names = sorted(ALPHABETS)
    return [(i, prose(seed + i, 20 + i % 50, ALPHABETS[names[i % 4]]), names[i % 4]) for i in range(n)]


@pytest.mark.parametrize("n", [2, 3, 4, 7, 9, 30])
def test_codewords_are_far_apart(n):
    code = L.codewords(n)
    assert len(code) == n and len({tuple(c) for c in code}) == n
    assert all(0 < c.sum() < n for c in code.T)
    assert L.distance(code) >= (1 if n == 2 else 2)


def test_held_out_accuracy(spark):
    rows = labelled(300)
    got = L.languages(documents(spark, rows, CLASHES)).collect()
    assert len(got) == 300
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    truth = {i: x for i, _, x in rows}
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_rows_teach_nothing(spark):
    rows = labelled(120)
    wrong = [(i, t, "cc" if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows]
    one, two = ({r.doc_id: tuple(r) for r in L.languages(documents(spark, x)).collect()} for x in (rows, wrong))
    assert one == two


def test_more_languages_than_dichotomies_and_a_bound_on_rows(spark):
    import string

    names = [f"l{i}" for i in range(9)]
    rows = [(i, prose(i, 60, string.ascii_lowercase[2 * (i % 9) : 2 * (i % 9) + 9]), names[i % 9]) for i in range(270)]
    model = L.learn(documents(spark, rows), rows=20)
    found = L.identify(documents(spark, rows), model).select("lang", "language.*").collect()
    assert sum(r.lang == r.lang_pred for r in found) > 0.95 * len(found)


def test_ambiguous_texts_are_flagged(spark):
    model = L.learn(documents(spark, labelled(200)))
    texts = [(1, prose(1, 60, ALPHABETS["aa"])), (2, "zz zz zz"), (3, prose(1, 60, ALPHABETS["aa"]) + " " + prose(1, 60, ALPHABETS["cc"]))]
    found = {r.doc_id: r for r in L.identify(documents(spark, texts), model).select("doc_id", "language.*").collect()}
    assert not found[1].ambiguous and found[2].ambiguous
    assert found[2].score < 0.9


def test_language_of_odd_rows(spark):
    rows = [*odd_rows(), *[(100 + i, t, x) for i, t, x in labelled(60)]]
    docs = documents(spark, rows, CLASHES)
    got = L.languages(docs).collect()
    assert len(got) == len(rows)
    unknown = {r.doc_id for r in got if r.lang_pred == "und"}
    assert unknown - {None} == {1, 2, 3, 4, 13}
    assert all(r.score == 0 and r.ambiguous for r in got if r.lang_pred == "und")
    model = L.learn(docs.where("lang is not null"))
    assert L.identify(docs, model).columns == [*[c for c in docs.columns if c != "language"], "language"]


def test_language_without_labels(spark):
    assert {r.lang_pred for r in L.languages(documents(spark, odd_rows())).collect()} == {"und"}
    assert L.languages(documents(spark, [])).collect() == []
    one = L.languages(documents(spark, [(i, "some text", "xx") for i in range(6)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("xx", 1.0)}


# Nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")


def exact(rows, queries, k):
    """Brute force over rows that take part."""
    fine = {i: np.asarray(v, np.float32).astype(float) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in fine:
            near = sorted((float(np.sqrt(((v - fine[q]) ** 2).sum())), i) for i, v in fine.items() if i != q and len(v) == len(fine[q]))
            out[q] = near[:k]
    return out


@pytest.mark.parametrize(("rows_per_block", "queries_per_block"), [(16384, 2048), (300, 4)])
def test_recall(spark, monkeypatch, rows_per_block, queries_per_block):
    monkeypatch.setattr(V, "ROWS", rows_per_block)
    monkeypatch.setattr(V, "QUERIES", queries_per_block)
    random_state = np.random.RandomState(0)
    data = random_state.standard_normal((1500, 32))
    data[:500] = data[0] + 0.1 * data[:500]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    got = V.nearest(vectors(spark, rows), F.col("id") % 100 == 0, 10).collect()
    want = exact(rows, range(0, 1500, 100), 10)
    hits = 0
    for q, near in want.items():
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        distance = {i: d for d, i in exact(rows, [q], 1500)[q]}
        assert all(abs(r.score - distance[r.vec_id]) < 1e-9 for r in mine)
        hits += len({r.vec_id for r in mine} & {i for _, i in near})
    assert hits >= 0.9 * 10 * len(want)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0])]
    rows += [(7, [float("inf"), 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, []), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (200, [3.0, 4.0, 5.0])]
    got = V.nearest(vectors(spark, rows), F.col("id") % 100 == 0, 10).collect()
    found = {q: [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100, 200)}
    want = exact(dict(rows).items(), [0, 100, 200], 10)
    assert {q: [i for _, i in near] for q, near in found.items()} == {q: [i for _, i in near] for q, near in want.items()}
    assert V.nearest(vectors(spark, []), F.col("id") % 100 == 0).collect() == []
    assert V.nearest(vectors(spark, [(1, [1.0])]), F.col("id") % 100 == 0).collect() == []


def test_collisions_are_those_of_the_windows():
    random_state = np.random.RandomState(1)
    data = random_state.standard_normal((200, 8))
    index = V.Index(data)
    values = data @ index.axes
    for half in (0.0, 0.3, 2.0, 100.0):
        want = (np.abs(values - values[5]) <= half).sum(axis=1)
        assert (np.abs(index.collisions(values[5], half).astype(int) - want) <= 1).all()
