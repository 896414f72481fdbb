"""Near-duplicate documents by DartMinHash.

A document is a weighted set: its five-word shingles with their counts. Per shingle,
hashed darts fall into regions of (weight, rank); those below the shingle's weight
count, and each of ``K`` coordinates keeps its earliest dart. Two documents agree in a
coordinate with the probability of their weighted Jaccard similarity, and only some
``K log K`` darts are looked at however long the document is. Bands of coordinates
give candidates, whose similarity is then computed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.components import blocked, components
from upkeep.llm.store import SMALL_BATCH, Kept, few, returning
from upkeep.llm.words import Words, mix, parts, sequence_hash

K = 80
BAND = 4
BANDS = K // BAND
SIMILARITY = 0.8
#: Ranks below 2**LOWEST are one level; each further level doubles the rank.
LOWEST = -5
#: Rows compared with one another in one task.
BLOCK = 1000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def weighted_shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct shingle, ascending by text and hash."""
    hashes, first = words.shingles()
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(hashes) != 0) | (np.diff(text) != 0)))) if len(hashes) else np.zeros(0, np.int64)
    return text[new], hashes[new], np.diff(np.append(new, len(hashes)))


def signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """(n, k) earliest darts of n weighted sets; ``NONE`` throughout for an empty set.

    Weights are positive whole numbers. Regions of weight are [0, 1), [1, 2), [2, 4), ...
    """
    best = np.full(n * k, NONE, np.uint64)
    if not len(text):
        return best.reshape(n, k)
    count = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    row = np.repeat(np.arange(len(text)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    low = np.where(step == 0, 0, 2.0 ** (step - 1))
    size = np.where(step == 0, 1.0, low)
    limit, owner = weight[row], text[row]
    base = mix(element[row] + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 3)

    total = np.bincount(text, weight, n)
    darts = k * np.log(k) + 2 * k
    with np.errstate(divide="ignore"):
        last = np.maximum(0, np.ceil(np.log2(darts / total)) - LOWEST)
    last[total == 0] = -1
    level = 0
    while True:
        live = last >= level
        if level:  # texts with a coordinate that no dart has hit go on
            live |= (best.reshape(n, k) == NONE).any(axis=1) & (total > 0)
        if not live.any():
            return best.reshape(n, k)
        at = np.flatnonzero(live[owner])
        start, length = (0.0, 2.0**LOWEST) if level == 0 else (2.0 ** (LOWEST + level - 1),) * 2
        cells = np.maximum(1, size[at] * length).astype(np.int64)
        cell = np.zeros(len(at), np.int64)
        if (cells > 1).any():
            cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
            at, cells = np.repeat(at, cells), np.repeat(cells, cells)
        area = size[at] * length / cells
        seed = mix(base[at] + cell.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03), 5 + level)
        chance = (seed >> np.uint64(11)) * 2.0**-53
        hit = np.flatnonzero(chance >= np.exp(-area))
        number = np.ones(len(hit), np.int64)  # of darts: the inverse of the Poisson distribution
        term, reached = np.exp(-area[hit]), np.exp(-area[hit])
        for i in range(1, 30):
            term = term * area[hit] / i
            reached = reached + term
            more = chance[hit] >= reached
            if not more.any():
                break
            number[more] = i + 1
        which = np.repeat(hit, number)
        turn = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        dart = mix(seed[which] + turn.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25), 4)
        second, third = mix(dart, 6), mix(dart, 7)
        region = at[which]
        inside = low[region] + size[region] * ((third >> np.uint64(11)) * 2.0**-53) < limit[region]
        which, dart, second, region = which[inside], dart[inside], second[inside], region[inside]
        rank = start + length * (cell[which] + (second >> np.uint64(11)) * 2.0**-53) / cells[which]
        value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | dart >> np.uint64(32)
        place = owner[region] * k + (dart & np.uint64(0xFFFFFFFF)).astype(np.int64) * k // (1 << 32)
        np.minimum.at(best, place, value)
        level += 1


def similarity(a: Words, b: Words) -> np.ndarray:
    """Weighted Jaccard similarity of each text of a with the same one of b."""
    n = len(a.first) - 1
    ta, ha, wa = weighted_shingles(a)
    tb, hb, wb = weighted_shingles(b)
    text, hashes, weight = np.concatenate((ta, tb)), np.concatenate((ha, hb)), np.concatenate((wa, wb))
    order = np.lexsort((hashes, text))
    text, hashes, weight = text[order], hashes[order], weight[order]
    same = np.flatnonzero((text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1]))
    shared = np.bincount(text[same], np.minimum(weight[same], weight[same + 1]), n)
    union = np.bincount(text, weight, n) - shared
    return np.divide(shared, union, out=np.zeros(n), where=union > 0)


def sign(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, word sequence as two hashes, signature (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch):
                words = Words(piece.column("text"))
                found = signatures(*weighted_shingles(words), piece.num_rows)
                short = mix(found, 9).astype("<u4").tobytes()
                some = np.diff(words.first) > 0
                rows = [short[4 * K * i : 4 * K * (i + 1)] if some[i] else None for i in range(len(some))]
                one = words.fingerprints()
                two = sequence_hash(mix(words.hashes, 12), words.first, 13)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(rows, pa.binary())],
                    ["doc_id", "one", "two", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(returning(run), "doc_id long, one long, two long, signature binary")


def buckets(nodes: DataFrame) -> DataFrame:
    """A row per node and band: band, key, node."""
    keys = [F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("signature", 1 + 4 * BAND * i, 4 * BAND), F.lit(i)).alias("key")) for i in range(BANDS)]
    return nodes.select("node", F.explode(F.array(*keys)).alias("b")).select("b.band", "b.key", "node")


def texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and text of the documents named by ``nodes`` (node), one row each.

    Sorted and merged at any size: ids grow with the data, so none are broadcast.
    """
    named = nodes.select(F.col("node").alias("doc_id")).distinct()
    return docs.join(named.hint("merge"), "doc_id").select("doc_id", "text").dropDuplicates(["doc_id"])


def verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of exact similarity ``least`` or more.

    A document in very many pairs makes a large partition, which AQE splits.
    """
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "text_a", "text_b"):
                found = similarity(Words(piece.column("text_a")), Words(piece.column("text_b")))
                frame = pa.RecordBatch.from_arrays([piece.column("a"), piece.column("b")], ["a", "b"])
                yield frame.filter(pa.array(found >= least))

    joined = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(returning(run), "a long, b long")


def _across(words: Words, component: np.ndarray, block: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links that join components of one group: a forest over them, by exact similarity.

    Rows outside the most frequent component are compared with all rows (of the other
    block, if there are two). Counts become sets by numbering equal shingles, and how
    many two rows share is a product of 0/1 matrices over shingles in several rows.
    """
    row, hashes, weight = weighted_shingles(words)
    total = np.bincount(row, weight, len(component))
    again = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    row, unit = np.repeat(row, weight), mix(np.repeat(hashes, weight) + again.astype(np.uint64), 14)
    _, column, held = np.unique(unit, return_inverse=True, return_counts=True)
    row, column = row[held[column] > 1], column[held[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    names, size = np.unique(component, return_counts=True)
    minor = np.flatnonzero(component != names[size.argmax()])
    shared = np.zeros((len(minor), len(component)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = max(1, (16 << 20) // (4 * len(component)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, (low, low + width))
        grid = np.zeros((len(component), min(width, int(column[-1]) + 1 - low)), np.float32)
        grid[row[i:j], column[i:j] - low] = 1
        shared += grid[minor] @ grid.T
    near = shared >= least * (total[minor][:, None] + total - shared) - 1e-6
    near &= component[minor][:, None] != component
    if block.min() != block.max():
        near &= block[minor][:, None] != block
    root = {c: c for c in names.tolist()}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(near)):
        a, b = find(int(component[minor[i]])), find(int(component[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((max(a, b), min(a, b)))
    return out


def join_across(open_rows: DataFrame, least: float) -> DataFrame:
    """Pairs of components (a, b) with a link between them within a bucket.

    open_rows: band, key, n, node, component, text. Of a bucket of more than ``BLOCK``
    rows every two blocks are a group of their own, so no task holds more than two.
    A group gives no more rows than it has components.
    """
    rows = blocked(open_rows, "node", BLOCK)
    group = ["band", "key", "low", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            texts = table.column("text")
            texts = texts.chunk(0) if texts.num_chunks == 1 else pa.concat_arrays(texts.chunks)
            found = _across(Words(texts), table.column("component").to_numpy(), table.column("block").to_numpy(), least)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

        for batch in batches:
            codes = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in group])
            cuts = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                mine = tuple(codes[:, i].tolist())
                if now is not None and mine != now:
                    yield done()
                    held = []
                now = mine
                held.append(batch.slice(i, j - i))
        if held:
            yield done()

    dealt = rows.select(*group, "block", "component", "text").repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(returning(run), "a long, b long").distinct()


def near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Classes of near-duplicate documents: doc_id, class_id, class_size, a row per row of docs.

    Documents are linked if the weighted Jaccard similarity of their shingles is at
    least ``least``; a class is what links connect, named by its smallest doc_id. Equal
    word sequences are one node. Per bucket every node is compared with one centre;
    then components that still share a bucket are compared row by row within tasks, so
    no candidate is left out. A text of fewer than five words has one
    shingle of them all. Texts without words (null, empty) and rows without doc_id are
    alone in their class. Further columns are not read.

    The bands miss a pair at 0.8 with probability 3e-5, and far more below, so lower
    thresholds are refused.
    """
    if least < SIMILARITY:
        raise ValueError(f"the bands are laid out for similarities of {SIMILARITY} and more")
    kept = Kept(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    signed = kept.keep(sign(docs), "signatures", SMALL_BATCH)
    with_words = signed.where("doc_id is not null and signature is not null")
    nodes = kept.keep(with_words.groupBy("one", "two").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "nodes")

    rows = kept.keep(buckets(nodes), "buckets")
    centres = rows.groupBy("band", "key").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", "band")).alias("centre")).where("n > 1")
    shared = kept.keep(rows.join(centres, ["band", "key"]), "shared")
    pairs = shared.where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    texts = kept.keep(texts_of(shared, docs), "texts")
    kept.release()
    links = kept.keep(verify(pairs, texts, least), "links", SMALL_BATCH)
    parts_of = kept.keep(components(links, kept), "components")

    placed = shared.join(parts_of, "node", "left").select("band", "key", "node", "n", F.coalesce("component", "node").alias("component"))
    placed = kept.keep(placed, "placed")
    still = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    open_rows = placed.join(still.select("band", "key"), ["band", "key"])
    open_rows = open_rows.join(texts.withColumnRenamed("doc_id", "node").hint("merge"), "node")
    across = kept.keep(join_across(open_rows, least), "across", SMALL_BATCH)
    merged = components(across, kept).select(F.col("node").alias("component"), F.col("component").alias("whole"))

    placed = nodes.join(parts_of, "node", "left").select("one", "two", F.coalesce("component", "node").alias("component"))
    classes = placed.join(merged, "component", "left").select("one", "two", F.coalesce("whole", "component").alias("class_id"))
    named = signed.join(classes, ["one", "two"], "left")
    alone = F.col("signature").isNull() | F.col("doc_id").isNull()
    named = kept.keep(named.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), alone.alias("alone")), "classes")
    kept.drop_all_but(named)
    sizes = named.where("not alone").groupBy("class_id").agg(F.count("*").alias("class_size"))
    together = named.where("not alone").join(sizes, "class_id").select("doc_id", "class_id", "class_size")
    return few(together.unionAll(named.where("alone").select("doc_id", "class_id", F.lit(1).cast("long").alias("class_size"))))
