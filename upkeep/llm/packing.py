"""Best-fit packing of documents into sequences by exact complements.

Only how many pieces there are of each length decides the plan, and lengths are
bounded by the sequence length, so the plan is made on the driver from at most
``sequence_length`` counts and the pieces are assigned to it by Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.store import MOST_PARTITIONS, SMALL_BATCH, Kept, returning
from upkeep.llm.tokens import Encoder, forget
from upkeep.llm.words import parts

#: Lengths in one sequence, and how many sequences are filled that way.
Pattern = tuple[tuple[int, ...], int]


#: Shortest members of pairs and of triples that are tried, in 32nds of the sequence length.
PAIR_FLOORS = (0, 5, 6, 7, 8, 9, 10)
TRIPLE_FLOORS = (0, 4, 5, 6, 7)


class Sums:
    """Index from a sum to the single length, pair or triple of available lengths with it.

    Of each sum the pairs are looked up by how balanced they are, so short lengths are
    spent last. Lengths only get fewer, so a pair or triple once spent stays so: the index
    holds, per sum, the shorter length of the first pair (shortest length of the first
    triple) that may still be there, and moves on from it, never back.
    """

    def __init__(self, left: Counter, pair_floor: int, triple_floor: int):
        self.left = left
        self.pair_floor = pair_floor
        self.triple_floor = triple_floor
        self.pairs: dict[int, int] = {}
        self.triples: dict[int, int] = {}

    def pair(self, total: int, floor: int) -> tuple[int, int] | None:
        """The most balanced available pair with this sum, the longer length first."""
        left = self.left
        b = self.pairs.get(total, total // 2)
        while b > 0 and (left[b] <= 0 or left[total - b] <= (2 * b == total)):
            b -= 1
        self.pairs[total] = b
        return (total - b, b) if b > 0 and b >= floor else None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """An available triple with this sum whose shortest length is as long as can be.

        Of the pairs beside ``c`` the most balanced one stands for all: one less balanced
        would hold a length shorter than ``c`` whenever this one does.
        """
        left = self.left
        least = max(1, self.triple_floor)
        c = self.triples.get(total, total // 3)
        found = None
        while c >= least:
            two = self.pair(total - c, c) if left[c] > 0 else None
            if two and left[c] > (two[0] == c) + (two[1] == c):
                found = (*two, c)
                break
            c -= 1
        self.triples[total] = c
        return found

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, three or two available lengths that fill the gap exactly."""
        if self.left[gap] > 0:
            return (gap,)
        return self.triple(gap) or self.pair(gap, self.pair_floor)


def plan(counts: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that use every piece exactly once; each fills ``size`` at most.

    Pairs and triples fill more gaps than single lengths but use up the short lengths
    that fill what best fit leaves. How short their members may be is therefore tried
    over a grid; of the plans with the fewest sequences the one that fills most of them
    by pairs and triples is taken. Best fit alone is among them, as the last resort.
    """
    if not any(counts.values()):
        return []
    floors = [(size * p // 32, size * t // 32) for p in PAIR_FLOORS for t in TRIPLE_FLOORS]
    plans = [exact_then_best_fit(counts, size, *f) for f in [*floors, (size, size)]]
    plans.append((best_fit(Counter(counts), size), 0))
    return min(plans, key=lambda p: (sum(times for _, times in p[0]), -p[1]))[0]


def exact_then_best_fit(counts: dict[int, int], size: int, pair_floor: int = 0, triple_floor: int = 0) -> tuple[list[Pattern], int]:
    """Patterns, and how many sequences of them a pair or triple has filled.

    From the longest length down, the gap beside it is filled exactly by one, three or
    two lengths, as often as all of them last. What finds no complement is put, longest
    first, where it leaves the smallest gap. Members of pairs and triples are no shorter
    than the floors.
    """
    left = Counter({n: c for n, c in counts.items() if c > 0})
    patterns: list[Pattern] = []
    sums = Sums(left, pair_floor, triple_floor)
    residue: Counter = Counter()
    combined = 0
    for n in sorted(left, reverse=True):
        while left[n] > 0:
            found: tuple[int, ...] | None = ()
            left[n] -= 1
            if n < size:
                found = sums.exact(size - n)
            if found is None:
                residue[n] += left[n] + 1
                left[n] = 0
                break
            left[n] += 1
            need = Counter((n, *found))
            times = min(left[k] // v for k, v in need.items())
            for k, v in need.items():
                left[k] -= v * times
            patterns.append(((n, *found), times))
            combined += times * (len(found) > 1)
    return patterns + best_fit(residue, size), combined


def best_fit(counts: Counter, size: int) -> list[Pattern]:
    """Best fit, longest first, over groups of like sequences instead of single ones."""
    bins: Counter = Counter()  # contents -> how many sequences
    by_gap: dict[int, list[tuple[int, ...]]] = {}
    gaps: list[int] = []

    def put(content: tuple[int, ...], times: int) -> None:
        if not bins[content]:
            gap = size - sum(content)
            if gap not in by_gap:
                by_gap[gap] = []
                insort(gaps, gap)
            by_gap[gap].append(content)
        bins[content] += times

    def take(content: tuple[int, ...], times: int) -> None:
        bins[content] -= times
        if not bins[content]:
            gap = size - sum(content)
            by_gap[gap].remove(content)
            if not by_gap[gap]:
                del by_gap[gap]
                gaps.remove(gap)

    for n in sorted(counts, reverse=True):
        rest = counts[n]
        while rest:
            at = bisect_right(gaps, n - 1)
            if at < len(gaps):
                content = by_gap[gaps[at]][0]
                times = min(rest, bins[content])
                take(content, times)
                put((*content, n), times)
            else:
                held = min(rest, size // n)
                times = rest // held
                put((n,) * held, times)
                times *= held
            rest -= times
    return [(content, times) for content, times in bins.items() if times]


def lower_bound(counts: dict[int, int], size: int) -> int:
    """No packing needs fewer sequences than this."""
    return -(-sum(n * c for n, c in counts.items()) // size)


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """Encode every whole text and cut it: doc_id, piece, start, length, ids_crc32.

    A null text is empty. A document of over ``size`` tokens is cut into pieces of
    ``size``, the first of which may be shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, keeps_blanks=True)
        for batch in batches:
            for part in parts(batch, size=4 << 20):
                ids, first = encoder.encode(part.column("text"))
                ids = np.insert(ids, first[1:], np.uint32(end_id))
                first = first + np.arange(len(first))
                total = np.diff(first)
                count = -(-total // size)
                row = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                head = (total - (count - 1) * size)[row]
                start = np.where(piece == 0, 0, head + (piece - 1) * size)
                length = np.where(piece == 0, head, size)
                raw = memoryview(ids.astype("<u4").tobytes())
                at = (first[row] + start) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length * 4).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        forget()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(returning(run), "doc_id long, piece int, start long, length long, ids_crc32 long")


def assign(pieces: DataFrame, kept: Kept, size: int, per_part: int = 100_000) -> DataFrame:
    """Add sequence_id and offset to stored pieces, by a plan over their lengths.

    The n-th piece of a length takes the n-th place the plan has for that length. Pieces
    are numbered per (partition of the number, length): the driver sees a count for
    each of those, never a piece, and no length goes to one task however frequent.
    """
    spark = pieces.sparkSession
    parts_wanted = min(MOST_PARTITIONS, max(1, -(-pieces.count() // per_part)))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts_wanted)).cast("int")
    numbered = pieces.withColumn("part", part)
    held = kept.keep(numbered.groupBy("length", "part").count(), "lengths")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("length", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    counts = Counter({r["length"]: r["n"] for r in held.groupBy("length").agg(F.sum("count").alias("n")).toLocalIterator()})

    # Places of each length: runs of equal patterns, in the order of the plan.
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
    used: Counter = Counter()
    first_id = 0
    for content, times in plan(counts, size):
        offset = 0
        content = tuple(sorted(content, reverse=True))
        slots: dict[int, list[int]] = {}
        for n in content:
            slots.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in slots.items():
            runs.setdefault(n, []).append((used[n], len(offsets), first_id, offsets[0]))
            used[n] += len(offsets) * times
        first_id += times
    table = {n: np.array(r, np.int64).T for n, r in runs.items()}
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        seen: Counter = Counter()
        for batch in batches:
            length = batch.column("length").to_numpy()
            part = batch.column("part").to_numpy()
            earlier = batch.column("before").to_numpy()
            order = np.lexsort((length, part))
            n, p = length[order], part[order]
            cuts = np.flatnonzero((np.diff(n) != 0) | (np.diff(p) != 0)) + 1
            sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(n)]):
                if i == j:
                    continue
                key = int(p[i]), int(n[i])
                number = earlier[order[i]] + seen[key] + np.arange(j - i)
                seen[key] += j - i
                start, each, ids, place = table[int(n[i])]
                at = np.searchsorted(start, number, "right") - 1
                inside = number - start[at]
                sequence[order[i:j]] = ids[at] + inside // each[at]
                offset[order[i:j]] = place[at] + inside % each[at] * n[i]
            fields = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*fields, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    ordered = numbered.join(before, ["part", "length"]).repartition(parts_wanted, "part").sortWithinPartitions("part", "doc_id", "piece", "ids_crc32")
    return ordered.mapInArrow(returning(run), schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 1024) -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is one piece of the end id alone. Repeated rows and null doc_ids are
    documents of their own. An empty table gives no row. Other columns are not read.
    """
    kept = Kept(docs.sparkSession)
    pieces = kept.keep(pieces_of(docs, tokenizer, end_id, size), "pieces", SMALL_BATCH)
    return assign(pieces, kept, size)
