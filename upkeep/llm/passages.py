"""Near-duplicate passages by compact windows.

For a hash function, the passages of a text that have their smallest shingle hash at
one place are those around it that contain it: a node of the Cartesian tree over the
hashes. Of these only the passages of ``LENGTH`` shingles matter here, and the runs of
their starts that share the smallest hash of two functions are a window. Windows of
equal hashes in different documents are joined, intervals of starts on which enough
hashes agree give candidates, and those are verified on the texts.

Windows of a key are linked to its first document, which may only resemble them. So
the nodes of one function are windows once more, under the shingles that follow the
smallest hash and under those that lead up to it: documents that agree word for word
meet there apart from those that share single shingles with them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.spans import code_points, merged, runs
from upkeep.llm.store import SMALL_BATCH, Kept, few, returning
from upkeep.llm.tokens import ranges
from upkeep.llm.words import _BASE, _UNBASE, SHINGLE, Words, mix, parts

WORDS = 50
LENGTH = WORDS - SHINGLE + 1
SIMILARITY = 0.8
#: Shingles of a passage that must be found in the other: a / (2 LENGTH - a) >= SIMILARITY.
MATCHED = int(np.ceil(2 * LENGTH * SIMILARITY / (1 + SIMILARITY) - 1e-9))
#: Pairs of hash functions; texts that agree in one pair at one place are verified.
BANDS = 6
ENOUGH = 1
#: Shingles of a word-for-word key: one side of any place in a passage has as many.
CONTEXT = LENGTH // 2 + 1
#: Windows of a batch that are held and sorted at once, about (a text's are never divided).
HELD = 1 << 20
#: Rows handed back to Spark at once, at most: the executor holds each such batch whole.
SENT = 1 << 16
#: Places by which the alignment may shift within a passage.
SHIFT = 8
#: Pairs of places compared at once, at most (of a place of a, all its alignments).
COMPARED = 1 << 20

# A place of a window in a long: first start (36 bits), starts (12), offset of the
# smallest hash from the first start (6), band (3).
_STARTS, _OFFSET, _BAND = 12, 6, 3
_MOST = (1 << _STARTS) - 1
_LOW = np.uint64((1 << 22) - 1)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def windows(hashes: np.ndarray, first: np.ndarray, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, key and packed place of all windows of some texts' shingles."""
    count = np.maximum(0, np.diff(first) - LENGTH + 1)
    starts = ranges(first[:-1], count)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(count)), count)
    inside = starts - first[:-1][text]
    place = np.arange(len(hashes), dtype=np.uint64) & _LOW
    found = []
    for band in range(bands):
        least = [sliding_min(mix(hashes, 20 + 2 * band + j) & ~_LOW | place, LENGTH)[starts] for j in range(2)]
        keys = mix((least[0] >> np.uint64(22)) ^ mix(least[1] >> np.uint64(22), 40 + band), 60 + band)
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])))
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(keys)))
        long = size > _MOST
        if long.any():  # a run too long for its field becomes several
            pieces = -(-size // _MOST)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head, size = np.repeat(head, pieces) + step * _MOST, np.minimum(_MOST, np.repeat(size, pieces) - step * _MOST)
        offset = ((least[0][head] & _LOW).astype(np.int64) - starts[head]) & int(_LOW)
        offset = np.minimum(offset, LENGTH - 1)
        packed = ((inside[head] << _STARTS | size) << _OFFSET | offset) << _BAND | band
        found.append((text[head], keys[head], packed))
    return tuple(np.concatenate(x) for x in zip(*found))


def contexts(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, key and packed place of the nodes of the first function, keyed word for word.

    A node is the run of starts that have their smallest hash at one place. One key is the
    hash of the ``CONTEXT`` shingles from that place on, another of those up to it, each
    where the text has as many; equal passages of ``LENGTH`` shingles share one of them.
    """
    count = np.maximum(0, np.diff(first) - LENGTH + 1)
    starts = ranges(first[:-1], count)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(hashes), dtype=np.uint64) & _LOW
    least = sliding_min(mix(hashes, 20) & ~_LOW | place, LENGTH)[starts]
    at = starts + (((least & _LOW).astype(np.int64) - starts) & int(_LOW))
    head = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    size = np.diff(np.append(head, len(at)))
    text, starts, at = text[head], starts[head], at[head]
    packed = (((starts - first[text]) << _STARTS | size) << _OFFSET | (at - starts)) << _BAND
    powers, inverse = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(hashes), x, np.uint64)))) for x in (_BASE, _UNBASE))
    total = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers[:-1])))
    found = []
    for band, low in ((BANDS, at), (BANDS + 1, at - CONTEXT + 1)):
        inside = (low >= first[text]) & (low + CONTEXT <= first[text + 1])
        low = low[inside]
        keys = mix((total[low + CONTEXT] - total[low]) * inverse[low], 80 + band)
        found.append((text[inside], keys, packed[inside] | band))
    return tuple(np.concatenate(x) for x in zip(*found))


def unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    """First start, starts, place of the smallest hash, band."""
    band = place & ((1 << _BAND) - 1)
    place = place >> _BAND
    offset = place & ((1 << _OFFSET) - 1)
    place = place >> _OFFSET
    first = place >> _STARTS
    return first, place & _MOST, first + offset, band


SCHEMA = pa.schema([("slot", pa.int64()), ("a", pa.int64()), ("at_a", pa.int64()), ("b", pa.int64()), ("at_b", pa.int64())])


def star(keys: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of sorted windows within each key, and which rows are of its first document.

    Every window of another document is linked to the first window of the first one,
    and the first one's further windows to the first window of the second document.
    """
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    end = np.append(head[1:], len(keys))
    first = np.repeat(head, end - head)
    own = doc == doc[first] if len(keys) else np.zeros(0, bool)
    other = np.flatnonzero(~own)
    size = np.add.reduceat(own.astype(np.int64), head) if len(head) else head
    second = np.where(head + size < end, head + size, -1)  # first row of the second document
    further = np.flatnonzero(own & (np.arange(len(keys)) != first))
    beside = np.repeat(second, end - head)[further]
    further, beside = further[beside >= 0], beside[beside >= 0]
    return np.concatenate((first[other], further)), np.concatenate((other, beside)), own


def all_windows(docs: DataFrame, bands: int) -> DataFrame:
    """Windows of all documents and links found within a part of a batch.

    A part links its own documents of equal keys to the first of them and passes that
    one on alone. So a passage in very many documents reaches a key's task once per
    part. Links have their own slot, spread evenly; windows have their key as slot
    and no b.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            doc_id, base = batch.column("doc_id").to_numpy(), 0
            for piece in parts(batch):
                shingles = Words(piece.column("text")).shingles()
                for text, keys, place in (windows(*shingles, bands), contexts(*shingles)):
                    found.append((doc_id[text + base], keys, place))
                    held += len(text)
                base += piece.num_rows
                if held >= HELD:
                    yield from first_links(found)
                    held = 0
        if found:
            yield from first_links(found)

    return docs.mapInArrow(returning(run), "slot long, a long, at_a long, b long, at_b long")


def first_links(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Windows of each key's first document among these (doc_id, key, place), then the links
    to them. The list is emptied."""
    columns = [np.concatenate(x) for x in zip(*found)]
    found.clear()
    order = order_of(columns[1], columns[0], columns[2])
    for i in range(len(columns)):
        columns[i] = columns[i][order]
    doc, keys, place = columns
    a, b, own = star(keys, doc, place)
    own = np.flatnonzero(own)
    for at in pieces(len(own)):
        rows = own[at]
        none = pa.nulls(len(rows), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(keys[rows].view(np.int64)), pa.array(doc[rows]), pa.array(place[rows]), none, none], schema=SCHEMA)
    for at in pieces(len(a)):
        one, two = a[at], b[at]
        slot = mix(doc[two].astype(np.uint64) + keys[two], 70).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, doc[one], place[one], doc[two], place[two])], schema=SCHEMA)


def order_of(keys: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Order by key, document and place; most keys stand alone, only the others need more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(keys) else order
    rows = order[tied]
    order[tied] = rows[np.lexsort((place[rows], doc[rows], keys[rows]))]
    return order


def pieces(rows: int) -> Iterator[slice]:
    """Slices of ``SENT`` rows at most."""
    for i in range(0, rows, SENT):
        yield slice(i, min(rows, i + SENT))


def links(found: DataFrame) -> DataFrame:
    """Pairs of windows (a, at_a, b, at_b) of equal keys, each with the first of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3  # windows of the first document of the last key
        for batch in batches:
            ready = batch.column("b").is_valid()
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(ready) for c in ("a", "at_a", "b", "at_b")], ["a", "at_a", "b", "at_b"])
            rest = batch.filter(pa.compute.invert(ready))
            if not rest.num_rows:
                continue
            slot, doc, place = (np.concatenate((h, rest.column(c).to_numpy())) for h, c in zip(held, ("slot", "a", "at_a")))
            a, b, own = star(slot, doc, place)
            last = np.flatnonzero(own & (slot == slot[-1]))
            held = [slot[last], doc[last], place[last]]
            for at in pieces(len(a)):
                one, two = a[at], b[at]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[one], place[one], doc[two], place[two])], ["a", "at_a", "b", "at_b"])

    ordered = found.repartition("slot").sortWithinPartitions("slot", "a", "at_a")
    return ordered.mapInArrow(returning(run), "a long, at_a long, b long, at_b long")


def candidates(at_a: np.ndarray, at_b: np.ndarray) -> list[tuple[int, int, int]]:
    """Interval join: alignments on which enough bands agree, as (shift, first, last start of a)."""
    first_a, size_a, least_a, band = unpacked(at_a)
    first_b, size_b, least_b, _ = unpacked(at_b)
    shift = least_b - least_a
    low = np.maximum(first_a, first_b - shift)
    high = np.minimum(first_a + size_a, first_b + size_b - shift) - 1
    low, high = np.minimum(low, high), np.maximum(low, high)
    order = np.argsort(shift, kind="stable")
    shift, low, high, band = shift[order], low[order], high[order], band[order]
    cuts = np.flatnonzero(np.diff(shift) > SHIFT) + 1
    out = []
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shift)]):
        if ENOUGH == 1 and i < j or len(np.unique(band[i:j])) >= ENOUGH:
            head = np.flatnonzero(np.concatenate(([True], shift[i + 1 : j] != shift[i : j - 1]))) + i
            ends = np.minimum.reduceat(low[:j], head), np.maximum.reduceat(high[:j], head)
            out += zip(shift[head].tolist(), ends[0].tolist(), ends[1].tolist())
    return out


def chain(at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A longest sequence of shared places that goes forward in both texts.

    The places come in ascending order in a, those of one place in a in descending order
    in b. A place that lies after all places before it, and before all after it, in both
    texts belongs to every such sequence; only the others are looked through.
    """
    solid = np.ones(len(at_a), bool)
    new = at_a[1:] > at_a[:-1]
    solid[1:] &= new & (at_b[1:] > np.maximum.accumulate(at_b)[:-1])
    solid[:-1] &= new & (at_b[:-1] < np.minimum.accumulate(at_b[::-1])[::-1][1:])
    rest = np.flatnonzero(~solid)
    if not len(rest):
        return at_a, at_b
    # How long a sequence gets up to each place, the last place first.
    before = places_before(at_b[rest].tolist())[::-1]
    # Before a place goes the nearest one that ends a sequence one shorter.
    i, back = -1, []
    for k in range(max(before), -1, -1):
        i = before.index(k, i + 1)
        back.append(i)
    solid[rest[len(rest) - 1 - np.array(back)]] = True
    return at_a[solid], at_b[solid]


def places_before(values: list[int]) -> list[int]:
    """How many values a longest ascending sequence has before each one that it ends with."""
    ends: list[int] = []
    out = []
    n = 0
    for b in values:
        k = bisect_left(ends, b)
        if k < n:
            ends[k] = b
        else:
            ends.append(b)
            n += 1
        out.append(k)
    return out


def shared(a: np.ndarray, b: np.ndarray, shifts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places with the same shingle in a and in b, for each run of neighbouring alignments.

    They come in the order that ``chain`` takes. Runs without any are left out.
    """
    out = []
    heads = np.flatnonzero(np.concatenate(([True], np.diff(shifts) > 1)))
    for least, width in zip(shifts[heads].tolist(), np.diff(np.append(heads, len(shifts))).tolist()):
        low, high = max(0, 1 - width - least), min(len(a), len(b) - least)
        if high <= low:
            continue
        # Row i holds b at i + alignment, the last alignment first.
        none = np.zeros(width, b.dtype)
        beside = sliding_window_view(np.concatenate((none, b, none)), width)[low + least + width : high + least + width, ::-1]
        step = max(1, COMPARED // width)
        hits = [np.flatnonzero(beside[k : k + step] == a[low + k : min(high, low + k + step), None]) + k * width for k in range(0, high - low, step)]
        hit = np.concatenate(hits) if len(hits) > 1 else hits[0]
        at_a = hit // width + low
        at_b = at_a + least + width - 1 - hit % width
        inside = (at_b >= 0) & (at_b < len(b))
        if not inside.all():
            at_a, at_b = at_a[inside], at_b[inside]
        if len(at_a):
            out.append((at_a, at_b))
    return out


def together(places: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The places of several runs of alignments, in the order that ``chain`` takes."""
    if len(places) == 1:
        return places[0]
    at_a, at_b = (np.concatenate(x) for x in zip(*places))
    order = np.lexsort((-at_b, at_a))
    return at_a[order], at_b[order]


def alike(a: np.ndarray, b: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """``forward`` of the places that two texts share on some alignments."""
    places = shared(a, b, shifts)
    return forward(*together(places)) if places else np.zeros((0, 4), np.int64)


def forward(at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Passages of any length from ``LENGTH`` shingles on: rows of first and last shingle
    in a, first and last in b.

    They begin and end with a shared shingle, and the shared ones of those on these
    alignments are at least ``SIMILARITY`` of all: n / (length in a + in b - n). With
    each first place goes the last one for which that holds.
    """
    if len(at_a) < LENGTH * SIMILARITY:
        return np.zeros((0, 4), np.int64)
    at_a, at_b = chain(at_a, at_b)
    worth = (1 + SIMILARITY) / SIMILARITY * np.arange(len(at_a)) - at_a - at_b
    best = np.maximum.accumulate(worth[::-1])  # of the places from one on, the last first
    least = worth - (1 + SIMILARITY) / SIMILARITY + 2 - 1e-9
    end = len(at_a) - 1 - np.searchsorted(best, least)
    first = np.arange(len(at_a))
    good = end >= first
    first, end = first[good], end[good]
    long = np.minimum(at_a[end] - at_a[first], at_b[end] - at_b[first]) + 1 >= LENGTH
    first, end = first[long], end[long]
    return np.stack((at_a[first], at_a[end], at_b[first], at_b[end]), axis=1)


def matched_spans(a: np.ndarray, b: np.ndarray, found: list[tuple[int, int, int]]) -> tuple[list, list]:
    """Passages of a and of b (first shingle, last shingle) of which enough shingles
    stand in the other text about where the alignment puts them, or that are alike in
    all, whatever their lengths."""
    seen = np.zeros(len(a), bool), np.zeros(len(b), bool)
    shifts = np.array(sorted({s for s, _, _ in found}))
    wide = np.unique(shifts[:, None] + np.arange(-SHIFT, SHIFT + 1))
    places = shared(a, b, wide)
    if not places:
        return [], []
    close = np.zeros(wide[-1] - wide[0] + 1, bool)
    close[(shifts[:, None] - wide[0] + np.arange(-1, 2)).ravel()] = True
    for at_a, at_b in places:
        hit = close[at_b - at_a - wide[0]]
        seen[0][at_a[hit]] = True
        seen[1][at_b[hit]] = True
    at = []
    for side in seen:
        total = np.concatenate(([0], np.cumsum(side)))
        at.append(np.flatnonzero(total[LENGTH:] - total[:-LENGTH] >= MATCHED))
    steps = [np.zeros(len(side) + 1, np.int64) for side in seen]
    if len(at[0]) and len(at[1]):
        for step, starts in zip(steps, at):
            step[starts] += 1
            step[starts + LENGTH] -= 1
    out = [spans(seen[i], steps[i]) for i in (0, 1)]
    # What lies within one span on each side cannot make it grow.
    groups = [group for group in places if not settled(*group, *out)]
    if len(places) > 1:
        whole = together(places)
        groups += [] if settled(*whole, *out) else [whole]
    if not groups:
        return out[0], out[1]
    passed = np.concatenate([forward(*group) for group in groups])
    for i in (0, 1):
        first, last = passed[:, 2 * i], passed[:, 2 * i + 1]
        seen[i][first] = seen[i][last] = True
        steps[i] += np.bincount(first, minlength=len(steps[i])) - np.bincount(last + 1, minlength=len(steps[i]))
    return spans(seen[0], steps[0]), spans(seen[1], steps[1])


def settled(at_a: np.ndarray, at_b: np.ndarray, own_a: list[tuple[int, int]], own_b: list[tuple[int, int]]) -> bool:
    """Whether each passage that ``forward`` could find among these places lies within a span on each side."""
    sides = (at_a, own_a), (at_b, own_b)
    if all(any(first <= x.min() and x.max() <= last for first, last in own) for x, own in sides):
        return True
    able = [stretches(x) for x, _ in sides]
    return not all(len(first) for first, _ in able) or all(held(*x, own) for x, (_, own) in zip(able, sides))


def stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places, and the last ones that go with them, of what could be one side of a passage.

    Of such a stretch, ``LENGTH`` shingles at least, ``SIMILARITY`` are shared places:
    n / (length in a + in b - n) is no more than n / length on either side.
    """
    low = int(places.min())
    mark = np.zeros(int(places.max()) - low + 1, bool)
    mark[places - low] = True
    at = np.flatnonzero(mark) + low
    worth = np.arange(len(at)) / SIMILARITY - at
    best = np.maximum.accumulate(worth[::-1])
    end = at[len(at) - 1 - np.searchsorted(best, worth - 1 / SIMILARITY + 1 - 1e-6)]
    able = end - at + 1 >= LENGTH
    return at[able], end[able]


def held(first: np.ndarray, end: np.ndarray, own: list[tuple[int, int]]) -> bool:
    """Whether each stretch lies within one of the spans, which ascend."""
    if not own:
        return False
    firsts, lasts = np.array(own).T
    k = np.searchsorted(firsts, first, "right") - 1
    return bool(((k >= 0) & (end <= lasts[k])).all())


def spans(seen: np.ndarray, steps: np.ndarray) -> list[tuple[int, int]]:
    """What the steps cover, from its first to its last shared shingle, if long enough."""
    out = []
    if not steps.any():
        return out
    for i, j in zip(*runs(np.cumsum(steps)[:-1] > 0)):
        hit = np.flatnonzero(seen[i:j]) + i
        if hit[-1] - hit[0] + 1 >= LENGTH:
            out.append((int(hit[0]), int(hit[-1])))
    return out


def verified(pairs: DataFrame, docs: DataFrame, kept: Kept) -> DataFrame:
    """Spans (doc_id, role, start, end, other) of candidate pairs, in code points.

    The larger doc_id of a pair has the role ``copy``, the smaller ``source``. Joins
    merge at any size: ids and pairs grow with the data, so none are broadcast.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = kept.keep(docs.join(ids.hint("merge"), "doc_id").dropDuplicates(["doc_id"]), "texts")
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "text_a", "text_b"):
                rows = []
                # The pairs of a document lie side by side, so its words are split once.
                _, once, same = np.unique(piece.column("a").to_numpy(), return_index=True, return_inverse=True)
                wa, wb = Words(piece.column("text_a").take(pa.array(once))), Words(piece.column("text_b"))
                (ha, fa), (hb, fb) = wa.shingles(), wb.shingles()
                text_a = same.tolist()
                for k, (a, b, at_a, at_b) in enumerate(zip(*(piece.column(c).to_pylist() for c in ("a", "b", "at_a", "at_b")))):
                    found = candidates(np.array(at_a), np.array(at_b))
                    if not found:
                        continue
                    i = text_a[k]
                    own = matched_spans(ha[fa[i] : fa[i + 1]], hb[fb[k] : fb[k + 1]], found)
                    if not (own[0] and own[1]):
                        continue
                    for mine, words, at, role, doc, other in ((own[0], wa, i, "source", a, b), (own[1], wb, k, "copy", b, a)):
                        low = code_points(words, at, np.array([s for s, _ in mine]), False)
                        high = code_points(words, at, np.array([e + SHINGLE - 1 for _, e in mine]), True)
                        rows += [(doc, role, int(s), int(e), other) for s, e in zip(low, high)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), SPAN.types)], schema=SPAN)

    joined = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "at_a", "at_b", "text_a", "text_b")
    return joined.mapInArrow(returning(run), "doc_id long, role string, start long, end long, other long")


SPAN = pa.schema([("doc_id", pa.int64()), ("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("other", pa.int64())])


def passages(docs: DataFrame, bands: int = BANDS) -> DataFrame:
    """Passages of at least 50 words that stand, nearly alike, in another document.

    Per document, role and passage: doc_id, role, start, end (code points, end not
    included), other. In the role ``copy`` a document with a smaller doc_id, ``other``
    being the smallest found, has the passage too; in the role ``source`` one with a
    larger. Documents without such passages have no row. Passages match if at least
    0.8 is the similarity of their sets of five-word shingles at aligned places.

    Repeats within one document alone do not count. Null and empty texts and texts of
    fewer than 50 words have no passage. Rows without doc_id are left out; of rows
    with equal doc_id one text is taken for verification. Further columns are not read.
    """
    kept = Kept(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    pairs = links(all_windows(docs, bands)).groupBy("a", "b").agg(F.collect_list("at_a").alias("at_a"), F.collect_list("at_b").alias("at_b"))
    pairs = kept.keep(pairs, "pairs", SMALL_BATCH)
    kept.release()  # the windows' shuffle is larger than the texts
    spans = kept.keep(verified(pairs, docs, kept), "spans", SMALL_BATCH)
    kept.drop_all_but(spans)
    kept.release()
    return few(merged(spans))
