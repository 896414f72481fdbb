"""Exact repeats between documents by a sparse suffix array.

Of each text only the suffixes that begin at a minimiser are kept: the smallest
shingle hash of ``WINDOW`` neighbours, so a passage of ``WORDS`` words has one within
its first half wherever it stands. A suffix carries the hash of the ``BLOCK`` words it
begins with and ``REACH`` words to both sides as 16-bit hashes. Suffixes are sorted by
what follows, and how far neighbours of equal blocks agree tells which runs of
``WORDS`` words around a block may stand elsewhere. Those are grouped by their hash,
with the smallest and the largest document that has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.passages import sliding_min
from upkeep.llm.spans import merged
from upkeep.llm.store import Kept, few
from upkeep.llm.tokens import ranges
from upkeep.llm.words import Words, mix, parts, sequence_hash

WORDS = 50
BLOCK = WORDS // 2
#: Shingles among which the smallest is chosen: one begins in the first half of a passage.
WINDOW = WORDS - BLOCK + 1
REACH = WORDS - BLOCK

SUFFIX = pa.schema(
    [
        ("block", pa.int64()),
        ("right", pa.binary()),
        ("left", pa.binary()),
        ("doc_id", pa.int64()),
        ("place", pa.int64()),
    ]
)
DDL = "block long, right binary, left binary, doc_id long, place long"
SPAN = pa.schema([("doc_id", pa.int64()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("other", pa.int64()), ("run", pa.int64())])
SPAN_DDL = "doc_id long, role string, start long, end long, other long, run long"
#: Suffixes whose runs are grouped at once.
PIECE = 20_000


def minimisers(hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place in it of the kept suffixes with a whole block.

    ``first``: numbers of the texts' first shingles; ``words``: how many words each has.
    """
    count = np.maximum(0, np.diff(first) - WINDOW + 1)
    starts = ranges(first[:-1], count)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << 22) - 1)
    least = sliding_min(mix(hashes, 80) & ~low | np.arange(len(hashes), dtype=np.uint64) & low, WINDOW)[starts]
    at = starts + (((least & low).astype(np.int64) - starts) & int(low))
    text = np.repeat(np.arange(len(count)), count)
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
    text, place = text[new], (at - first[:-1][text])[new]
    whole = place + BLOCK <= words[text]
    return text[whole], place[whole]


def suffixes(docs: DataFrame) -> DataFrame:
    """Kept suffixes of all documents of at least ``WORDS`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch):
                words = Words(piece.column("text"))
                hashes, first = words.shingles()
                count = np.diff(words.first)
                text, place = minimisers(hashes, first, np.where(count >= WORDS, count, 0))
                if not len(text):
                    continue
                at = words.first[text] + place
                runs = np.arange(len(at) + 1) * BLOCK
                block = sequence_hash(words.hashes[ranges(at, np.full(len(at), BLOCK))], runs, 81)
                short = np.maximum(1, words.hashes >> np.uint64(48)).astype("<u2")
                step = np.arange(REACH)
                right, left = at[:, None] + BLOCK + step, at[:, None] - 1 - step
                inside = right < words.first[text + 1][:, None]
                right = np.where(inside, short[np.minimum(right, len(short) - 1)], 0).astype("<u2")
                inside = left >= words.first[text][:, None]
                left = np.where(inside, short[np.maximum(left, 0)], 0).astype("<u2")
                doc = piece.column("doc_id").to_numpy()[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.view(np.int64)), _fixed(right), _fixed(left), pa.array(doc), pa.array(place)], schema=SUFFIX
                )

    return docs.mapInArrow(run, DDL)


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    size = rows.shape[1] * rows.itemsize
    offsets = pa.array(np.arange(len(rows) + 1) * size, pa.int32()).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _words(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REACH)


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the first on are the same, per row."""
    apart = (a != b) | (a == 0)
    return np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])


def run_hashes(block: np.ndarray, right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Per suffix the hashes of the ``WORDS`` words around it with 0, 1, ... ``REACH`` of them before its block."""
    step = np.arange(REACH, dtype=np.uint64)
    none = np.zeros((len(block), 1), np.uint64)
    before = np.concatenate((none, np.cumsum(mix(left + mix(step, 82), 83), axis=1)), axis=1)
    after = np.concatenate((none, np.cumsum(mix(right + mix(step, 84), 85), axis=1)), axis=1)
    return mix(mix(before, 86) + mix(after[:, ::-1], 87) + block.astype(np.uint64)[:, None] + mix(np.arange(REACH + 1, dtype=np.uint64), 88), 89)


def _spans(doc: np.ndarray, start: np.ndarray, row: np.ndarray, run: np.ndarray, whole: bool) -> Iterator[pa.RecordBatch]:
    """Spans of the runs that several documents have. Runs of a suffix follow one another, the last one first.

    If these are not all documents with the runs, the first is handed on as a possible
    copy and the last as a possible source, with the run: the others' roles are settled.
    """
    order = np.argsort(run)
    head = np.flatnonzero(np.concatenate(([True], np.diff(run[order].view(np.uint64)) != 0)))
    size = np.diff(np.append(head, len(run)))
    low, high = np.empty_like(doc), np.empty_like(doc)
    low[order] = np.repeat(np.minimum.reduceat(doc[order], head), size)
    high[order] = np.repeat(np.maximum.reduceat(doc[order], head), size)
    apart = np.concatenate(([True], row[1:] != row[:-1]))
    for role, mask, other in (("copy", doc > low, low), ("source", doc < high, high)):
        before = np.concatenate(([False], mask[:-1]))
        first = np.flatnonzero(mask & (apart | ~before))
        last = np.flatnonzero(mask & np.append(apart[1:] | ~mask[1:], True))
        stretch = np.where(mask, other, np.iinfo(np.int64).max)
        columns = (doc[first], [role] * len(first), start[last], start[first] + WORDS, np.minimum.reduceat(stretch, first) if len(first) else first)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, SPAN.types)), pa.nulls(len(first), pa.int64())], schema=SPAN)
        if not whole:
            at = np.flatnonzero(~mask)
            columns = (doc[at], [role] * len(at), start[at], start[at] + WORDS)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, SPAN.types)), pa.nulls(len(at), pa.int64()), pa.array(run[at])], schema=SPAN)


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of runs of ``WORDS`` words that stand in other documents, of one sorted partition.

    No suffix agrees with what follows a suffix further than the nearest one before and
    after it, of the same block but another document. So many words after the block a
    shared run has at most. The first and the last block may go on in the partitions
    beside, and very frequent blocks are worked on in pieces: of the documents with a
    run of theirs the first and the last are handed on with its hash.
    """
    batches = list(batches)
    table = pa.Table.from_batches(batches, SUFFIX) if batches else None
    if table is None or not table.num_rows:
        return
    block, doc, place = (table.column(c).to_numpy() for c in ("block", "doc_id", "place"))
    n = len(block)
    right, left = _words(table.column("right")), _words(table.column("left"))
    new_block = np.concatenate(([True], block[1:] != block[:-1]))
    new_run = new_block | np.concatenate(([True], doc[1:] != doc[:-1]))
    head = np.flatnonzero(new_run)
    run = np.cumsum(new_run) - 1
    start, end = head[run], np.append(head[1:], n)[run]
    reach = np.full(n, -1, np.int64)
    i = np.flatnonzero(~new_block[start])
    j = np.flatnonzero((end < n) & ~np.append(new_block, True)[np.minimum(end, n)])
    for mine, other in ((i, start[i] - 1), (j, end[j])):
        reach[mine] = np.maximum(reach[mine], common(right[mine], right[other]))
    edge = (start == 0) | (end == n)
    reach[edge] = common(right[edge], right[edge])
    before = common(left, left)  # words the text has there

    heads = np.flatnonzero(new_block)
    size = np.diff(np.append(heads, n))
    on = (heads == 0) | (heads + size == n) | (size > PIECE)
    on = np.repeat(on, size)
    some = (reach >= 0) & (before + reach >= REACH)
    number = np.cumsum(new_block)

    def pieces(at: np.ndarray, whole: bool) -> Iterator[np.ndarray]:
        """Suffixes in pieces of about ``PIECE``, of whole blocks if asked."""
        low = 0
        while low < len(at):
            high = min(len(at), low + PIECE)
            if whole and high < len(at):
                high = int(np.searchsorted(number[at], number[at[high]]))
            yield at[low:high]
            low = high

    for mask, whole in ((some & ~on, True), (some & on, False)):
        for at in pieces(np.flatnonzero(mask), whole):
            hashes = run_hashes(block[at], right[at], left[at])
            least = REACH - reach[at]
            count = before[at] - least + 1
            row = np.repeat(np.arange(len(at)), count)
            ahead = ranges(least, count)
            yield from _spans(doc[at][row], place[at][row] - ahead, row, hashes[row, ahead].view(np.int64), whole)


def repeats(docs: DataFrame) -> DataFrame:
    """Passages of at least 50 words that stand word for word in another document.

    Per document, role and passage: doc_id, role, start, end (words, end not
    included), other. The role ``copy`` covers all words of runs of 50 that a document
    with a smaller doc_id has too, ``other`` being the smallest compared; the role
    ``source`` those that one with a larger has.
    Overlapping passages are one. Documents without any have no row. Words are those
    of ``upkeep.llm.words``, so case and punctuation do not matter.

    Repeats within one document alone do not count. Null, empty and short texts have
    no passage; rows without doc_id are left out; rows with equal doc_id are one
    document. Further columns are not read.
    """
    kept = Kept(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    columns = ["block", "right", "left", "doc_id", "place"]
    found = suffixes(docs).repartitionByRange(*columns).sortWithinPartitions(*columns)
    found = kept.keep(found.mapInArrow(shared_runs, SPAN_DDL), "runs")
    kept.release()  # the suffixes' shuffle is larger than the spans
    of_run = Window.partitionBy("run")  # two documents of each piece, so few however frequent the run is
    open_rows = found.where("run is not null")
    open_rows = open_rows.withColumn("low", F.min("doc_id").over(of_run)).withColumn("high", F.max("doc_id").over(of_run))
    other = F.when(F.col("role") == "copy", F.col("low")).otherwise(F.col("high"))
    settled = open_rows.withColumn("other", other).where("doc_id <> other").select("doc_id", "role", "start", "end", "other")
    return few(merged(found.where("run is null").drop("run").unionByName(settled)))
