import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from upkeep.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, block string, task long, score string, low string, dim string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "b", 1, "s", "l", "d") for i, v, l in rows], SCHEMA)


def mine(spark, rows, **settings):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = N.hard_negatives(N.quantized(vectors(spark, rows), label), F.col("id") % 100 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def brute(rows, positives=5, negatives=10):
    fine = {}
    for i, v, l in rows:
        if i is None or v is None or l is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(x))) for x in v)
        if sum(x * x for x in q) < 2**62:
            fine[i, (l + 1) % 10 if i % 7 == 0 else l, q] = None
    out = []
    for a in fine:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in fine if b != a and len(b[2]) == len(a[2]))
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fit = [(t, n) for t, n, l in scored if l != a[1] and 30 * -s <= 100 * -t <= 90 * -s][:negatives]
            out += [(a[0], p, k + 1, n, -s, -t) for k, (t, n) in enumerate(fit)]
    return sorted(out)


def drawn(n, dim=8, seed=1, clusters=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(clusters, 1), dim)) * (1 if clusters else 0)
    v = centres[rng.integers(0, max(clusters, 1), n)] + rng.standard_normal((n, dim)) * (0.1 if clusters else 0.3)
    return [(i, v[i].tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("clusters", [0, 5])
def test_all_pairs_give_the_same(spark, monkeypatch, clusters):
    for name, value in (("ROWS", 50), ("ANCHORS", 3), ("SAMPLE", 100)):
        monkeypatch.setattr(N, name, value)
    rows = drawn(900, clusters=clusters)
    assert mine(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(4)
    rows = drawn(250)
    rows += [(1000, None, 1), (1001, [0.1] * 8, None), (None, [0.1] * 8, 1), (1100, [float("nan")] + [0.1] * 7, 1), (1101, [float("inf")] + [0.1] * 7, 1), (1102, [None] + [0.1] * 7, 1)]
    rows += [(1200, [0.0] * 8, 1), (1201, [0.0] * 8, 1), (1202, [0.0] * 8, 2)]  # zero vectors score 0
    rows += [(1300, [], 1), (1301, [], 1), (1302, [], 2)]  # and so do empty ones
    rows += [(1400 + i, [rng.choice([0.5, 1.0]) for _ in range(3)], i % 2) for i in range(30)]  # another dimension, many ties
    rows += [(1500, [2.0**40] * 8, 1), (1501, [2.0**15] * 8, 1), (1502, [2.0**15, -(2.0**13)] * 4, 2), (1600, [2.0**15] * 8, 1)]  # too large; beyond exact doubles
    rows += [rows[100], rows[100], (200, [0.2] * 8, 2), (200, [0.25] * 8, 2)]  # repeated rows and one id on several
    assert mine(spark, rows) == brute(rows)


def test_few_rows(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(1, [1.0], 0)]) == []
    assert mine(spark, [(100, [1.0], 0)]) == []
    assert mine(spark, [(100, [1.0], 0), (101, [1.0], 0)]) == []
    assert mine(spark, [(100, [1.0], 0), (101, [1.0], 0), (103, [0.5], 1)]) == [(100, 101, 1, 103, 65536, 32768)]
    assert mine(spark, [(100, [1.0], 0), (101, [-1.0], 0), (103, [-0.5], 1)]) == []  # no window below zero


def test_a_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 20)
    rows = drawn(300) + [(1000 + i, [0.4] * 8, i % 3) for i in range(150)]
    assert mine(spark, rows) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    by = {6: N.directions(rng.standard_normal((50, 6)))}
    v = np.concatenate((rng.integers(-99, 99, (200, 6)), np.repeat([[7, 7, 7, 7, 7, 7]], 3, 0), np.zeros((1, 6), int), [[1, 0, 0, 0, 0, 0]], [[-1, 0, 0, 0, 0, 0]]))
    norm = np.linalg.norm(v, axis=1)
    with np.errstate(invalid="ignore"):
        angles = np.arccos(np.clip(np.nan_to_num(v @ by[6].T / norm[:, None]), -1, 1)).astype(np.float32).astype(float)
    near, far = np.zeros((len(v), len(v))), np.full((len(v), len(v)), np.pi)
    for r in range(N.REFERENCES):
        a, b = angles[:, r][:, None], angles[None, :, r]
        near, far = np.maximum(near, abs(a - b)), np.minimum(far, np.minimum(a + b, 2 * np.pi - a - b))
    norms = norm[:, None] * norm[None, :]
    low, high = N.reach(near, far, norms, norms)
    assert (low <= v @ v.T).all() and (v @ v.T <= high).all()


def packed(rows, by, extra=None):
    """One block of id, label, v as the operator packs it."""
    v = np.array([r[2] for r in rows], np.int64)
    norm = np.linalg.norm(v, axis=1)
    angles = np.arccos(np.clip(v @ by.T / norm[:, None], -1, 1)).astype(np.float32)
    table = pa.table({"id": [r[0] for r in rows], "label": [r[1] for r in rows], "key": [0] * len(rows), "v": N.lists(v), "dim": pa.array([v.shape[1]] * len(rows), pa.int32()), "norm": norm, "angles": N.lists(angles), "cell": pa.array([0] * len(rows), pa.int32()), "near": angles.min(axis=1), **(extra or {})})
    return N.block(0, table).column("data")[0].as_py()


def test_far_rows_are_not_scored():
    """On vectors in clusters, most rows leave by their bounds."""
    rows = [(i, l, np.floor(256 * np.array(v)).astype(int).tolist()) for i, v, l in drawn(4000, 16, 3, clusters=12)]
    by = N.directions(np.array([r[2] for r in rows[:500]], float))
    anchors = rows[:40]
    top = [[int(1e9)]] * len(anchors)
    best = [[sorted((-np.dot(a[2], b[2]) for b in rows if b[1] == a[1] and b[0] != a[0]))[4] * -1] for a in anchors]
    search = N.Search(packed(anchors, by, {"lows": best, "highs": top}), True, 5)
    search.meet(packed(rows, by))
    assert len(search.best["slot"]) >= 200
    assert search.scored < 0.1 * len(anchors) * len(rows)


def test_the_query_gives_the_rows_of_its_twin(spark):
    import duckdb

    from upkeep.llm.queries import ORACLES, QUERIES

    connection = duckdb.connect()
    connection.execute("CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/sf0.01/embeddings.parquet'")
    name = "op11_hard_negatives"
    assert sorted(map(tuple, QUERIES[name](spark, "/root/testdata/sf0.01").collect())) == sorted(connection.execute(ORACLES[name]).fetchall())
