"""Approximate nearest neighbours by counting collisions in single projections.

Every block of rows has an index of its own: for each random projection its rows
sorted by value. Around a query's value a window opens in each of these arrays; the
windows widen together (virtual rehashing: radius R, 2**0.25 R, ...), and a row that
lies in enough windows is verified by its true distance. A query is done with a block
when its k nearest verified rows lie within the radius, or all rows are verified.
"""

from __future__ import annotations



import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 96
#: Half width of a window for radius 1: rows at that distance lie in it with probability 0.68.
HALF = 1.0
#: Windows a row must lie in: two standard deviations below what a row at the radius has.
SHARE = 0.6827 - 2 * np.sqrt(0.6827 * 0.3173 / PROJECTIONS)
GROWTH = 2**0.25
ROWS = 16384
QUERIES = 2048


def projections(dimension: int) -> np.ndarray:
    return np.random.RandomState(dimension).standard_normal((dimension, PROJECTIONS))


class Index:
    """Sorted projections of one block of rows."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.axes = projections(vectors.shape[1])
        values = vectors @ self.axes
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(values, order, axis=0).T.copy()
        rank = np.empty(values.shape, np.uint16 if len(vectors) <= 1 << 16 else np.uint32)
        np.put_along_axis(rank, order, np.arange(len(values), dtype=rank.dtype)[:, None], axis=0)
        self.rank = rank.T.copy()

    def collisions(self, values: np.ndarray, half: float) -> np.ndarray:
        """In how many windows around the query's values each row lies."""
        count = np.zeros(len(self.vectors), np.uint16)
        for line, rank, value in zip(self.sorted, self.rank, values):
            low, high = np.searchsorted(line, value - half, "left"), np.searchsorted(line, value + half, "right")
            if high > low:
                count += (rank - rank.dtype.type(low)) < rank.dtype.type(high - low) if high - low < len(line) else np.uint16(1)
        return count

    def nearest(self, query: np.ndarray, own: int, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows found nearest to a query, the query's own row left out, and their distances."""
        values = query @ self.axes
        distance = np.full(len(ids), np.inf)
        seen = ids == own
        wanted = min(k, int((~seen).sum()))
        if not wanted:
            return np.zeros(0, np.int64), np.zeros(0)
        radius = self.start
        while True:
            fresh = np.flatnonzero((self.collisions(values, radius * HALF) >= SHARE * PROJECTIONS) & ~seen)
            if len(fresh):
                distance[fresh] = np.sqrt(((self.vectors[fresh] - query) ** 2).sum(axis=1))
                seen[fresh] = True
            if seen.all() or (np.isfinite(distance).sum() >= wanted and np.partition(distance, wanted - 1)[wanted - 1] <= radius):
                break
            radius *= GROWTH
        order = np.lexsort((ids, distance))[:wanted]
        return order, distance[order]

    @property
    def start(self) -> float:
        """The first radius: half of how far rows lie from their mean."""
        return max(float(np.sqrt(self.vectors.var(axis=0).sum())) / 2, 1e-12)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: id, v (doubles). Null and zero vectors and those with null
    or non-finite components do not."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null").where(fine & some)


def nearest(vectors: DataFrame, queries, k: int = 10) -> DataFrame:
    """The k nearest rows found for each query row: query_id, rank, vec_id, score.

    vectors: vec_id, embedding. ``queries`` is a condition on ``id``. Score is the
    Euclidean distance in double precision; ties go to the smaller vec_id. Vectors of
    different dimension are never compared. Repeated rows of a vec_id count once.
    Rows are dealt over blocks by a hash of the id, queries too, and each pair of blocks
    is one group; a block's answer has k rows per query, and two rounds of ranking
    put them together.
    """
    rows = usable(vectors).dropDuplicates(["id"])
    asked = rows.where(queries)
    n, q = rows.count(), asked.count()
    n_blocks, q_blocks = max(1, -(-n // ROWS)), max(1, -(-q // QUERIES))
    mine = rows.withColumn("row_block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    theirs = asked.withColumn("query_block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(q_blocks)).cast("int")).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    theirs = theirs.select("row_block", "query_block", F.col("id").alias("query_id"), F.col("v").alias("asked"))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        for size in sorted(set(right["asked"].map(len)) & set(left["v"].map(len))):
            base, ask = left[left["v"].map(len) == size], right[right["asked"].map(len) == size]
            base = base.sort_values("id")
            ids, index = base["id"].to_numpy(), Index(np.stack(base["v"].to_numpy()))
            for own, vector in zip(ask["query_id"].to_numpy(), ask["asked"].to_numpy()):
                at, distance = index.nearest(np.asarray(vector), own, ids, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids[at], "score": distance}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = mine.groupBy("row_block", "query_block").cogroup(theirs.groupBy("row_block", "query_block")).applyInPandas(search, "query_id long, vec_id long, score double")
    few = Window.partitionBy("query_id", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n_blocks // 64)))).orderBy("score", "vec_id")
    found = found.withColumn("rank", F.row_number().over(few)).where(F.col("rank") <= k).drop("rank")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
