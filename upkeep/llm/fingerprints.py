"""SimHash fingerprints, and all fingerprints within a Hamming radius of each other.

Every occurrence of a three-word shingle adds its hash's bits as signed votes, so a
shingle weighs as often as it stands in the text; the signs of the sums are the
fingerprint. To find near ones, fingerprints are cut into more blocks than bits may
differ, so some choice of blocks is equal in both: there is one table per choice,
keyed by the blocks chosen (the permuted prefix).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.components import blocked, components
from upkeep.llm.store import Kept, few, id_bounds, range_of
from upkeep.llm.words import Words, mix, parts

BITS = 128
TERM = 3
RADIUS = 6
ROWS = 4096
#: Rows of a table compared with one another in one task.
BLOCK = 1000


def fingerprints(texts: pa.Array) -> np.ndarray:
    """(n, BITS / 8) bytes; a text without words has no votes and all bits zero."""
    words = Words(texts)
    hashes, first = words.shingles(TERM)
    out = np.zeros((len(texts), BITS // 8), np.uint8)
    some = np.flatnonzero(np.diff(first) > 0)
    if not len(some):
        return out
    halves = []
    for half in range(BITS // 64):
        bits = np.unpackbits(mix(hashes, 90 + half).view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
        halves.append(np.packbits(2 * ones > np.diff(first)[some][:, None], axis=1))
    out[some] = np.concatenate(halves, axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine that the differing bits stand for, from 0 (unrelated) to 1 (equal)."""
    apart = np.unpackbits(a ^ b, axis=1).sum(axis=1) / BITS
    return np.where(apart == 0, 1.0, np.maximum(0.0, np.cos(np.pi * apart)))


def with_next(docs: DataFrame, rows: int = ROWS) -> tuple[DataFrame, int]:
    """Documents dealt out by ranges of ids, sorted, each range followed by the next one's first.

    Columns: part, tail (1 for that last row), doc_id, text. After the last document
    comes the first. Null doc_ids stand first, equal ones by text.
    """
    bounds = id_bounds(docs, "doc_id", rows)
    part = range_of("doc_id", bounds)
    own = docs.select(part.alias("part"), F.lit(0).alias("tail"), "doc_id", "text")
    least = docs.groupBy(part.alias("part")).agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("none"))
    firsts = sorted((r.part, r.none, r.doc_id) for r in least.collect())  # one id per range
    tails = None
    for none in (False, True):
        named = [(p, i) for p, has_none, i in firsts if bool(has_none) == none]
        if not named:
            continue
        same = F.col("doc_id").isNull() if none else F.col("doc_id").isin([i for _, i in named])
        some = docs.where(same).groupBy("doc_id").agg(F.min("text").alias("text"), F.max(F.col("text").isNull()).alias("empty"))
        some = some.select(range_of("doc_id", bounds).alias("own"), "doc_id", F.when(~F.col("empty"), F.col("text")).alias("text"))
        tails = some if tails is None else tails.unionAll(some)
    if tails is None:
        return own, 1
    order = [p for p, _, _ in firsts]
    before = F.create_map(*[F.lit(x) for pair in zip(order, order[-1:] + order[:-1]) for x in pair])
    tails = tails.select(before[F.col("own")].alias("part"), F.lit(1).alias("tail"), "doc_id", "text")
    return own.unionAll(tails), len(bounds) + 1


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each whole text, of its edited text, and how near they are.

    The edited text has its last quarter of code points (rounded down) replaced by the
    first as many of the next document by ascending doc_id; see ``with_next``. Per row
    of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null texts count as empty ones. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row waits for the one after it
        for batch in batches:
            for piece in parts(batch):
                if held is not None:
                    piece = pa.concat_batches([held, piece])
                held = piece.slice(piece.num_rows - 1)
                yield described(piece)
        # A partition's last row is a tail, which is not described itself.

    def described(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in piece.column("text").to_pylist()]
        part, tail = piece.column("part").to_numpy(), piece.column("tail").to_numpy()
        n = len(texts) - 1
        mine = np.flatnonzero((tail[:-1] == 0) & (part[:-1] == part[1:]))
        sizes = [len(t) for t in texts]
        edited = [t[: s - s // 4] + u[: s // 4] for t, u, s in zip(texts, texts[1:], sizes)]
        prints = fingerprints(pa.array(texts, pa.string()))
        after = fingerprints(pa.array([edited[i] for i in mine], pa.string()))
        own, following = prints[:n][mine], prints[1:][mine]
        return pa.RecordBatch.from_arrays(
            [
                piece.column("doc_id").take(pa.array(mine)),
                pa.array([sizes[i] for i in mine], pa.int64()),
                pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in mine], pa.string()),
                pa.array([x.tobytes().hex() for x in own], pa.string()),
                pa.array([x.tobytes().hex() for x in after], pa.string()),
                pa.array(likeness(own, after)),
                pa.array(likeness(own, following)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    rows, n = with_next(docs.select(F.col("doc_id").cast("long"), "text"))
    return rows.repartition(n, "part").sortWithinPartitions("part", "tail", "doc_id", "text").mapInArrow(run, schema)


def table_keys(count: int, radius: int) -> list[list[tuple[int, int]]]:
    """For each table, the (first bit, bits) of its key.

    With more blocks than ``radius``, two fingerprints within it agree in some
    ``blocks - radius`` of them. The blocks are as many as keep the keys about as long
    as the number of fingerprints asks for: longer keys, more tables.
    """
    need = math.log2(max(2, count)) - 4
    blocks = next((b for b in range(radius + 1, 2 * radius + 2) if BITS * (b - radius) // b >= need), 2 * radius + 1)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in chosen] for chosen in combinations(range(blocks), blocks - radius)]


def _tables(frame: DataFrame, keys: list[list[tuple[int, int]]]) -> DataFrame:
    """A row per fingerprint and table: table, key, print."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = np.frombuffer(bytes.fromhex("".join(batch.column("print").to_pylist())), np.uint8).reshape(batch.num_rows, -1)
            bits = np.unpackbits(grid, axis=1)
            for table, chosen in enumerate(keys):
                part = np.packbits(np.concatenate([bits[:, a : a + n] for a, n in chosen], axis=1), axis=1)
                rows = [x.tobytes() for x in part]
                yield pa.RecordBatch.from_arrays([pa.array([table] * len(rows), pa.int32()), pa.array(rows, pa.binary()), batch.column("print")], ["table", "key", "print"])

    return frame.mapInArrow(run, "table int, key binary, print string")


def _near_pairs(prints: np.ndarray, first: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of the same group within the radius; groups begin at ``first`` (n + 1)."""
    size = np.diff(first)
    row = np.arange(first[-1])
    after = np.repeat(first[1:], size) - row - 1  # rows of the group behind each row
    a = np.repeat(row, after)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
    near = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1) <= radius
    return a[near], b[near]


def _forest(prints: np.ndarray, block: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that connect what lies within the radius in a large group, not all pairs.

    With two blocks, only rows of different ones are compared.
    """
    rows = np.flatnonzero(block == block.min())
    others = rows if block.min() == block.max() else np.flatnonzero(block == block.max())
    root = np.arange(len(prints))
    a, b = [], []
    for i in rows:
        near = others[np.bitwise_count(prints[others] ^ prints[i]).sum(axis=1) <= radius]
        near = near[root[near] != root[i]]
        for j in near[np.unique(root[near], return_index=True)[1]]:
            a.append(int(i))
            b.append(int(j))
            root[root == root[j]] = root[i]
    return a, b


#: Groups of up to so many rows are compared together.
SMALL = 64


def near_prints(rows: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) of fingerprints within the radius of each other, as far as they are
    needed to connect a group. rows: table, key, n, print.

    A group of more than ``BLOCK`` rows is compared block by block.
    """
    group = ["table", "key", "low", "side"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last group may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            new = starts(table)
            held = table.slice(new[-1])
            yield links(table.slice(0, new[-1]), new)
        if held is not None:
            yield links(held, np.array([0, held.num_rows]))

    def starts(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for c in group:
            column = table.column(c).combine_chunks()
            column = column.dictionary_encode().indices.to_numpy() if pa.types.is_binary(column.type) else column.to_numpy()
            new[1:] |= column[1:] != column[:-1]
        return np.flatnonzero(new)

    def links(table: pa.Table, first: np.ndarray) -> pa.RecordBatch:
        names = table.column("print")
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if table.num_rows:
            prints = np.frombuffer(bytes.fromhex("".join(names.to_pylist())), np.uint8).reshape(table.num_rows, -1).view(np.uint64)
            first = np.append(first[first < table.num_rows], table.num_rows)
            size = np.diff(first)
            few = np.where(size <= SMALL, size, 0)
            at = np.flatnonzero(np.repeat(few > 0, size))
            a, b = _near_pairs(prints[at], np.concatenate(([0], np.cumsum(few[few > 0]))), radius)
            a, b = [at[a]], [at[b]]
            block = table.column("block").to_numpy()
            for i, j in zip(first[:-1][size > SMALL], first[1:][size > SMALL]):
                x, y = _forest(prints[i:j], block[i:j], radius)
                a.append(np.array(x, np.int64) + i)
                b.append(np.array(y, np.int64) + i)
            a, b = np.concatenate(a), np.concatenate(b)
        found = [names.take(pa.array(x)).combine_chunks() for x in (a, b)]
        found = [x.chunk(0) if isinstance(x, pa.ChunkedArray) and x.num_chunks else pa.array([], pa.string()) if isinstance(x, pa.ChunkedArray) else x for x in found]
        return pa.RecordBatch.from_arrays(found, ["a", "b"])

    dealt = blocked(rows, "print", BLOCK).select(*group, "block", "print").repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, "a string, b string").distinct()


def print_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Classes of distinct fingerprints (hex, column print): print, class.

    Linked are any two within ``radius`` bits; a class is what links connect, named by
    its smallest fingerprint. Repeated rows count once, nulls are left out.
    """
    kept = Kept(prints.sparkSession)
    distinct = kept.keep(prints.where("print is not null").select("print").distinct(), "prints")
    rows = kept.keep(_tables(distinct, table_keys(distinct.count(), radius)), "tables")
    shared = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    found = near_prints(rows.join(shared, ["table", "key"]), radius)
    placed = components(found, kept)
    return distinct.join(placed, distinct["print"] == placed["node"], "left").select("print", F.coalesce("component", "print").alias("class"))


def fingerprint_classes(described: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Add class_id to described documents: the smallest doc_id among those whose
    fingerprints are connected by steps of at most ``radius`` bits."""
    kept = Kept(described.sparkSession)
    described = kept.keep(described, "described")
    classes = print_classes(described.select(F.col("fingerprint").alias("print")), radius)
    first = described.groupBy("fingerprint").agg(F.min("doc_id").alias("least")).join(classes, F.col("fingerprint") == F.col("print"))
    named = kept.keep(first.select("fingerprint", "class", "least"), "named")
    ids = named.groupBy("class").agg(F.min("least").alias("class_id"))
    classed = named.join(ids, "class").select("fingerprint", "class_id")
    return few(described.join(classed, "fingerprint").select(*described.columns, "class_id"))
