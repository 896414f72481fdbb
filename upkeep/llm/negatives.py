"""Hard negatives by integer scores, with angular triangle filtering.

Every vector has stored angles to a few reference directions. Two vectors with angles
a and b to a reference lie between |a - b| and min(a + b, 2 pi - a - b) apart, so each
reference bounds the cosine of their angle, and with the norms their inner product.
Rows are kept in blocks, sorted by their nearest reference and the angle to it; a block
has intervals of angles and norms. Anchors meet a block only if the bounds of both
overlap the scores they still look for, within it the bounds of single rows are tested,
and only rows that pass are scored, in integers.

First the anchors' nearest positives are looked for among the blocks of their own
reference; the worst of them is what others must reach. The positives' scores then give
the windows for negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.store import stored

#: Reference directions, and those whose bounds are tested row by row.
REFERENCES, TESTED = 16, 4
#: Rows from which the references are chosen, about. They decide the speed, never the result.
SAMPLE = 2048
#: Rows of a block; anchors of a group, and those scored at once.
ROWS, ANCHORS, CHUNK = 2048, 32768, 512
#: Tasks per core that groups of anchors are divided into, where there are fewer groups,
#: and blocks that a task meets at least.
TASKS, FEWEST = 8, 4
#: Norms from here on make scores that a long does not hold.
LIMIT = 2.0**31
#: More than angles stored with four bytes, and cosines near 1, are off by.
SLACK = 2e-6
#: Below every score.
NONE = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """Rows that take part: id, label, v (longs, floor of scale * x), key.

    Null ids, labels and vectors do not, nor vectors with null or non-finite components,
    nor those whose integer norm is 2**31 or more. Repeated rows are one, and copies
    collapse before they are moved. ``key`` tells rows of one id apart.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v")).dropna()
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    short = F.aggregate("v", F.lit(0.0), lambda total, x: total + F.floor(x * scale).cast("double") ** 2) < LIMIT**2
    rows = rows.where(fine).where(short).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))
    return rows.distinct().withColumn("key", F.xxhash64("label", "v"))


def directions(sample: np.ndarray) -> np.ndarray:
    """Unit vectors, each the one of the sample that is farthest from those before it."""
    norms = np.linalg.norm(sample, axis=1)
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return fallback(sample.shape[1])
    chosen = [int(np.argmax(units @ units.mean(axis=0)))]
    nearest = units @ units[chosen[0]]
    while len(chosen) < min(REFERENCES, len(units)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return np.resize(units[chosen], (REFERENCES, units.shape[1]))


def fallback(dimension: int) -> np.ndarray:
    """References for vectors of a dimension that the sample does not have."""
    drawn = np.random.RandomState(dimension).standard_normal((REFERENCES, dimension))
    return drawn / np.linalg.norm(drawn, axis=1)[:, None] if dimension else drawn


def references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions by dimension, from some ``SAMPLE`` rows chosen by a hash."""
    n = rows.count()
    few = rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64("id", "key"), F.lit(1 << 30)) < int(SAMPLE / n * (1 << 30)))
    found: dict[int, list[list[int]]] = {}
    for row in few.select("v").orderBy(F.xxhash64("v")).limit(2 * SAMPLE).collect():
        found.setdefault(len(row.v), []).append(row.v)
    return {size: directions(np.array(sample, float).reshape(len(sample), size)) for size, sample in found.items()}


def indexed(rows: DataFrame, by: dict[int, np.ndarray]) -> DataFrame:
    """The rows with dim, norm, angles, cell (the nearest reference) and near, the angle to it."""
    schema = "id long, label long, key long, v array<long>, dim int, norm double, angles array<float>, cell int, near float"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.diff(batch.column("v").offsets.to_numpy())
            for dim in np.unique(size):
                part = batch.take(pa.array(np.flatnonzero(size == dim)))
                v = matrix(part, "v", int(dim)).astype(float)
                norm = np.sqrt((v * v).sum(axis=1))
                axes = by.get(int(dim), fallback(int(dim)))
                cosine = np.divide(v @ axes.T, norm[:, None], out=np.zeros((len(v), REFERENCES)), where=norm[:, None] > 0)
                angles = np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)
                cell = angles.argmin(axis=1)
                more = {"dim": np.full(len(v), dim, np.int32), "norm": norm, "angles": lists(angles), "cell": cell.astype(np.int32), "near": angles.min(axis=1)}
                yield pa.RecordBatch.from_pydict({**{c: part.column(c) for c in ("id", "label", "key", "v")}, **{c: x if isinstance(x, pa.Array) else pa.array(x) for c, x in more.items()}})

    return rows.select("id", "label", "key", "v").mapInArrow(run, schema)


def matrix(batch, column: str, width: int) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    values = batch.column(column)
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), width)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(values.ravel()))


BLOCK = "block long, dim int, cell int, low array<float>, high array<float>, short double, long double, least double, most double, data binary"


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows of one dimension and cell, near in angle.

    ``low`` and ``high`` bound the angles, ``short`` and ``long`` the norms, ``least`` and
    ``most`` the scores looked for (columns of anchors). ``data`` are the rows as Arrow
    bytes, by id. Rows are sorted by range, so any cell may hold most of them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held else pa.Table.from_batches([batch])
            place = held.column("dim").to_numpy().astype(np.int64) * REFERENCES + held.column("cell").to_numpy()
            ends = np.flatnonzero(np.append(place[1:] != place[:-1], True)) + 1
            start = 0
            for end in ends.tolist():  # the last one may go on in the next batch
                while start < end and (end < len(place) or end - start >= size):
                    stop = min(end, start + size)
                    yield block(number, held.slice(start, stop - start))
                    number, start = number + 1, stop
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield block(number, held)

    order = ["dim", "cell", "near", "id", "key"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCK)


def block(number: int, rows: pa.Table) -> pa.RecordBatch:
    dim = rows.column("dim")[0].as_py()
    angles, norm = matrix(rows, "angles", REFERENCES), rows.column("norm").to_numpy()
    v = matrix(rows, "v", dim)
    kind = next(t for t in (np.int16, np.int32, np.int64) if not v.size or np.abs(v).max() <= np.iinfo(t).max)
    at = rows.schema.get_field_index("v")
    kept = rows.set_column(at, "v", lists(v.astype(kind))).drop_columns(["dim", "cell", "near"]).sort_by([("id", "ascending"), ("key", "ascending")])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, kept.schema) as writer:
        writer.write_table(kept)
    wanted = [float(f(rows.column(c).to_numpy())) if c in rows.column_names else e for c, f, e in (("least", np.min, -np.inf), ("most", np.max, np.inf))]
    row = {"block": number, "dim": dim, "cell": rows.column("cell")[0].as_py(), "low": angles.min(axis=0), "high": angles.max(axis=0), "short": norm.min(), "long": norm.max(), "least": wanted[0], "most": wanted[1], "data": sink.getvalue().to_pybytes()}
    types = {"block": pa.int64(), "dim": pa.int32(), "cell": pa.int32(), "low": pa.list_(pa.float32()), "high": pa.list_(pa.float32())}
    return pa.RecordBatch.from_pydict({c: pa.array([x], types.get(c)) for c, x in row.items()})


def reach(gap_low: np.ndarray, gap_high: np.ndarray, short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of vectors whose angle and product of norms lie
    between these bounds, rounded outwards."""
    most, least = np.cos(np.maximum(gap_low - SLACK, 0)), np.cos(np.minimum(gap_high + SLACK, np.pi))
    pad = long * 1e-9 + 1
    return np.where(least < 0, long, short) * least - pad, np.where(most > 0, long, short) * most + pad


def reach_columns(a: str, b: str) -> tuple[Column, Column]:
    """``reach`` for two blocks."""
    at = F.sequence(F.lit(0), F.lit(REFERENCES - 1))
    near = F.array_max(F.transform(at, lambda i: F.greatest(F.lit(0.0), F.col(f"{b}.low")[i] - F.col(f"{a}.high")[i], F.col(f"{a}.low")[i] - F.col(f"{b}.high")[i])))
    far = F.array_min(F.transform(at, lambda i: F.least(F.col(f"{a}.high")[i] + F.col(f"{b}.high")[i], 2 * np.pi - F.col(f"{a}.low")[i] - F.col(f"{b}.low")[i])))
    most, least = F.cos(F.greatest(near - SLACK, F.lit(0.0))), F.cos(F.least(far + SLACK, F.lit(np.pi)))
    long, short = F.col(f"{a}.long") * F.col(f"{b}.long"), F.col(f"{a}.short") * F.col(f"{b}.short")
    pad = long * 1e-9 + 1
    return F.when(least < 0, long).otherwise(short) * least - pad, F.when(most > 0, long).otherwise(short) * most + pad


class Search:
    """What a group of anchors has found in the blocks it has met.

    Every anchor has slots, each with a window of scores and its best ``k`` rows so far.
    """

    def __init__(self, data: bytes, same_label: bool, k: int):
        rows = pa.ipc.open_stream(data).read_all()
        self.same, self.k = same_label, k
        self.id, self.key, self.label = (rows.column(c).to_numpy() for c in ("id", "key", "label"))
        self.norm, self.n = rows.column("norm").to_numpy(), len(rows)
        self.angles = matrix(rows, "angles", REFERENCES).astype(float)
        self.v = matrix(rows, "v", len(rows.column("v")[0]))
        low, high = (rows.column(c).to_pylist() for c in ("lows", "highs"))
        self.slots = max(map(len, low))
        self.low = np.array([[*x, *[-NONE - 1] * (self.slots - len(x))] for x in low], np.int64)
        self.high = np.array([[*x, *[NONE] * (self.slots - len(x))] for x in high], np.int64)
        self.limit = self.low.copy()  # what a row must score to be among the best
        empty = np.zeros(0, np.int64)
        self.best = {c: empty for c in ("slot", "score", "id", "key")}
        self.scored = 0

    def meet(self, data: bytes) -> None:
        rows = pa.ipc.open_stream(data).read_all()
        theirs = {c: rows.column(c).to_numpy() for c in ("id", "key", "label", "norm")}
        theirs |= {"angles": matrix(rows, "angles", REFERENCES).astype(float), "v": matrix(rows, "v", self.v.shape[1])}
        low, high = theirs["angles"].min(axis=0), theirs["angles"].max(axis=0)
        near = np.maximum(np.maximum(low - self.angles, self.angles - high), 0).max(axis=1)
        far = np.minimum(self.angles + high, 2 * np.pi - self.angles - low).min(axis=1)
        bottom, top = reach(near, far, self.norm * theirs["norm"].min(), self.norm * theirs["norm"].max())
        open_ = np.flatnonzero((top >= self.limit.min(axis=1)) & (bottom <= self.high.max(axis=1)))
        for i in range(0, len(open_), CHUNK):
            self._meet(open_[i : i + CHUNK], theirs)

    def _meet(self, own: np.ndarray, theirs: dict[str, np.ndarray]) -> None:
        used = np.argsort(self.angles[own].mean(axis=0))[:TESTED]
        near, far = np.zeros((len(own), len(theirs["id"]))), np.full((len(own), len(theirs["id"])), np.pi)
        for r in used:
            a, b = self.angles[own, r][:, None], theirs["angles"][None, :, r]
            np.maximum(near, np.abs(a - b), out=near)
            np.minimum(far, np.minimum(a + b, 2 * np.pi - a - b), out=far)
        norms = self.norm[own][:, None] * theirs["norm"][None, :]
        bottom, top = reach(near, far, norms, norms)
        fit = (top >= self.limit[own].min(axis=1)[:, None]) & (bottom <= self.high[own].max(axis=1)[:, None])
        fit &= (self.label[own][:, None] == theirs["label"][None, :]) == self.same
        fit &= (self.id[own][:, None] != theirs["id"][None, :]) | (self.key[own][:, None] != theirs["key"][None, :])
        mine, rows = np.flatnonzero(fit.any(axis=1)), np.flatnonzero(fit.any(axis=0))
        if not len(mine):
            return
        own, fit = own[mine], fit[np.ix_(mine, rows)]
        self.scored += int(fit.sum())
        small = norms.max() < 2.0**53  # then no sum of the products is rounded
        kind = float if small else np.int64
        score = (self.v[own].astype(kind) @ theirs["v"][rows].astype(kind).T).astype(np.int64)
        ids, keys = theirs["id"][rows], theirs["key"][rows]
        found = []
        for j in range(self.slots):
            inside = fit & (score >= self.limit[own, j][:, None]) & (score <= self.high[own, j][:, None])
            if len(rows) > self.k:
                held = np.where(inside, score, NONE)
                inside &= score >= np.partition(held, len(rows) - self.k, axis=1)[:, len(rows) - self.k][:, None]
            i, r = np.nonzero(inside)
            found.append((own[i] * self.slots + j, score[i, r], ids[r], keys[r]))
        self._keep([np.concatenate(x) for x in zip(*found)])

    def _keep(self, found: list[np.ndarray]) -> None:
        slot, score, id_, key = (np.concatenate((self.best[c], x)) for c, x in zip(("slot", "score", "id", "key"), found))
        order = np.lexsort((key, id_, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else slot
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = order[rank < self.k]
        self.best = {"slot": slot[rank < self.k], "score": score[kept], "id": id_[kept], "key": key[kept]}
        full = rank == self.k - 1
        self.limit.ravel()[slot[full]] = score[order[full]]

    def found(self) -> pa.RecordBatch:
        anchor, slot = np.divmod(self.best["slot"], self.slots)
        columns = {"anchor": self.id[anchor], "anchor_key": self.key[anchor], "slot": slot.astype(np.int32), "found": self.best["id"], "found_key": self.best["key"], "score": self.best["score"]}
        return pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in columns.items()})


FOUND = "anchor long, anchor_key long, slot int, found long, found_key long, score long"


def search(anchors: DataFrame, table: DataFrame, same_label: bool, k: int, where: Column, name: str) -> DataFrame:
    """The best k rows of each anchor's slots within each task: the columns of FOUND.

    ``anchors`` are index rows with lows and highs (the slots' windows), least and most
    (over all slots). Their groups and the blocks are paired by number, pairs whose bounds
    do not overlap go, and each task streams its share of one group's blocks, likely
    ones first, holding a group and one batch of blocks. ``where`` limits the pairs of
    blocks (of ``g``, a group, and ``b``).
    """
    groups = stored(blocks(anchors, ANCHORS), f"{name}-groups")
    n = groups.count()
    spark = anchors.sparkSession
    if not n:
        return spark.createDataFrame([], FOUND)
    # As many rows as there are groups of up to 32 768 anchors, without their data.
    numbered = stored(groups.drop("data").withColumn("group", F.row_number().over(Window.orderBy("block")) - 1), f"{name}-numbers")
    stripes = max(1, min(-(-TASKS * max(2, spark.sparkContext.defaultParallelism) // n), table.count() // FEWEST))
    own = numbered.select("group", F.struct(*[c for c in numbered.columns if c != "group"]).alias("g"))
    pairs = table.drop("data").select(F.struct(*[c for c in table.columns if c != "data"]).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("group"))
    bottom, top = reach_columns("g", "b")
    pairs = pairs.join(own, "group").where("g.dim = b.dim").where(where)
    pairs = pairs.select("group", F.col("b.block").alias("block"), top.alias("top"), bottom.alias("bottom"), "g.least", "g.most").where("top >= least and bottom <= most")
    task = F.col("group") * stripes + F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int")
    met = pairs.select("block", task.alias("task"), (-F.col("top")).alias("order")).join(table.select("block", "data"), "block").select("task", "order", "data")
    heads = groups.join(numbered.select("block", "group"), "block").select(F.explode(F.sequence(F.col("group") * stripes, F.col("group") * stripes + stripes - 1)).alias("task"), F.lit(float("-inf")).alias("order"), "data")
    dealt = heads.unionAll(met).repartitionById(n * stripes, F.col("task").cast("int")).sortWithinPartitions("task", "order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now = None, None
        for batch in batches:
            for number, order, data in zip(batch.column("task").to_pylist(), batch.column("order").to_pylist(), batch.column("data")):
                if order == float("-inf"):
                    if now is not None:
                        yield now.found()
                    task, now = number, Search(data.as_py(), same_label, k)
                elif number == task:
                    now.meet(data.as_py())
        if now is not None:
            yield now.found()

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, str(16 << 20))
        return stored(dealt.mapInArrow(run, FOUND), f"{name}-found")
    finally:
        spark.conf.set(setting, before)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor's slots over all tasks, with their rank from 1."""
    order = Window.partitionBy("anchor", "anchor_key", "slot").orderBy(F.desc("score"), "found", "found_key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share(score: Column, percent: int, up: bool) -> Column:
    """percent * score / 100 rounded, without overflow."""
    whole, rest = F.expr("score div 100"), F.expr("score % 100")
    exact = rest * percent / 100.0
    return whole * percent + (F.ceil(exact) if up else F.floor(exact)).cast("long")


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` as ``quantized`` returns them; ``anchors`` is a condition on id. An anchor's
    positives are the other rows of its label with the greatest inner product. For each,
    the best rows of other labels with a score of ``low`` to ``high`` percent of the
    positive's, both included; ties go to the smaller id. Vectors of different
    dimension are never compared, and zero and empty vectors score 0. A positive
    with a negative score has no window, an anchor without positives no row. Rows of
    one id that differ are rows of their own. An empty table gives an empty one.
    """
    rows = stored(rows, "negatives-rows")
    index = stored(indexed(rows, references(rows)), "negatives-index")
    table = stored(blocks(index, ROWS), "negatives-blocks")
    asked = index.where(anchors)
    any_score = {"lows": F.array(F.lit(int(NONE) + 1)), "highs": F.array(F.lit((1 << 63) - 1)), "least": F.lit(float("-inf")), "most": F.lit(float("inf"))}
    same_cell = F.col("g.cell") == F.col("b.cell")

    near = best(search(asked.withColumns(any_score), table, True, positives, same_cell, "negatives-near"), positives)
    worst = near.where(F.col("rank") == positives).select(F.col("anchor").alias("id"), F.col("anchor_key").alias("key"), F.col("score").alias("worst"))
    bound = F.coalesce("worst", F.lit(int(NONE) + 1))
    rest = asked.join(worst, ["id", "key"], "left").withColumns({**any_score, "lows": F.array(bound), "least": F.coalesce(F.col("worst").cast("double"), F.lit(float("-inf")))}).drop("worst")
    far = search(rest, table, True, positives, ~same_cell, "negatives-far")
    liked = stored(best(near.drop("rank").unionAll(far), positives), "negatives-positives")

    window = liked.withColumns({"first": share(F.col("score"), low, True), "last": share(F.col("score"), high, False)}).where("first <= last")
    slots = F.array_sort(F.collect_list(F.struct("rank", "first", "last", "found", "found_key", "score")))
    wanted = window.groupBy(F.col("anchor").alias("id"), F.col("anchor_key").alias("key")).agg(slots.alias("slots"), F.min("first").cast("double").alias("least"), F.max("last").cast("double").alias("most"))
    wanted = stored(wanted, "negatives-windows")
    looking = asked.join(wanted.select("id", "key", F.col("slots.first").alias("lows"), F.col("slots.last").alias("highs"), "least", "most"), ["id", "key"])
    mined = best(search(looking, table, False, negatives, F.lit(True), "negatives-mined"), negatives)
    of = wanted.select(F.col("id").alias("anchor"), F.col("key").alias("anchor_key"), F.posexplode("slots").alias("slot", "positive"))
    return mined.join(of, ["anchor", "anchor_key", "slot"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive.found").alias("positive_id"),
        "rank",
        F.col("found").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
