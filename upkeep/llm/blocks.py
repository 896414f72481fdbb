"""Token ids in files of patched frame-of-reference blocks.

Per block of ``BLOCK`` ids the minimum is subtracted and the rest packed at the width
that a given share of the ids fits; the few wider ids are exceptions, kept whole in a
list. A file holds the documents of one range of ids, ascending:

    magic (8 bytes)
    blocks, each: minimum u32, count u32, width u8, 0 u8, exceptions u16,
        exceptions' places u16 and values u32, packed ids u64 in ``LANES`` lanes
    index: start of each block u64
    documents: has_id u8, doc_id i64, n_tokens u64, one array after the other
    trailer: places of index and documents, n_blocks, n_docs, n_ids as u64

All numbers are little-endian. Files are written by tasks, under a name of the
attempt; the manifest names those that count, so a task that runs twice does no harm.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.llm.store import id_bounds, new_path, range_of
from upkeep.llm.tokens import Encoder
from upkeep.llm.words import parts

MAGIC = b"UKPFOR1\n"
BLOCK = 256
LANES = 4
ROWS = BLOCK // LANES
SHARE = 0.95
HEAD = struct.Struct("<IIBBH")
TRAILER = struct.Struct("<5Q")
#: Blocks decoded at once.
RUN = 4096
MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def _bits(values: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width as (blocks, LANES, width) words of 64 bits."""
    lanes = values.astype(np.uint64).reshape(-1, ROWS, LANES)
    out = np.zeros((len(values), LANES, width), np.uint64)
    for row in range(ROWS):
        word, shift = divmod(row * width, 64)
        out[:, :, word] |= lanes[:, row] << np.uint64(shift)
        if shift + width > 64:
            out[:, :, word + 1] |= lanes[:, row] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), ROWS, LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for row in range(ROWS):
        word, shift = divmod(row * width, 64)
        part = words[:, :, word] >> np.uint64(shift)
        if shift + width > 64:
            part = part | words[:, :, word + 1] << np.uint64(64 - shift)
        out[:, row] = part & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """Blocks of these ids; only the last may be short. It is filled with its minimum."""
    if not len(ids):
        return []
    count = np.full(-(-len(ids) // BLOCK), BLOCK)
    count[-1] = len(ids) - BLOCK * (len(count) - 1)
    table = np.empty(len(count) * BLOCK, np.uint32)
    table[: len(ids)] = ids
    table[len(ids) :] = ids[BLOCK * (len(count) - 1) :].min()
    table = table.reshape(-1, BLOCK)
    least = table.min(axis=1)
    rest = table - least[:, None]
    full = _bits(rest.max(axis=1))
    place = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    width = _bits(np.partition(rest, place, axis=1)[:, place])
    # Exceptions must pay: 6 bytes each against the bits saved on the block.
    wide = (rest >> np.minimum(width, 31).astype(np.uint32)[:, None] > 0) & (width < 32)[:, None]
    dear = wide.sum(axis=1) * 48 >= (full - width) * BLOCK
    width = np.where(dear, full, width)
    wide &= ~dear[:, None]
    packed: list[bytes] = [b""] * len(table)
    kept = np.where(wide, 0, rest)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        for i, words in zip(at, _pack(kept[at], int(w))):
            packed[i] = words.tobytes()
    out = []
    for i, body in enumerate(packed):
        at = np.flatnonzero(wide[i])
        out.append(
            HEAD.pack(int(least[i]), int(count[i]), int(width[i]), 0, len(at))
            + at.astype("<u2").tobytes()
            + table[i, at].astype("<u4").tobytes()
            + body
        )
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at these places of the data."""
    heads = [HEAD.unpack_from(data, int(s)) for s in starts]
    width = np.array([h[2] for h in heads], np.int64)
    out = np.zeros((len(heads), BLOCK), np.uint64)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        size = 8 * LANES * int(w)
        bodies = [int(starts[i]) + HEAD.size + 6 * heads[i][4] for i in at]
        words = np.frombuffer(b"".join(data[b : b + size] for b in bodies), "<u8").reshape(len(at), LANES, int(w))
        out[at] = _unpack(words, int(w))
    out += np.array([h[0] for h in heads], np.uint64)[:, None]
    for i, h in enumerate(heads):
        if h[4]:
            place = int(starts[i]) + HEAD.size
            at = np.frombuffer(data, "<u2", h[4], place)
            out[i, at] = np.frombuffer(data, "<u4", h[4], place + 2 * h[4])
    flat = out.astype(np.uint32).reshape(-1)
    count = np.array([h[1] for h in heads])
    if (count == BLOCK).all():
        return flat
    return flat[(np.arange(BLOCK) < count[:, None]).reshape(-1)]


class Writer:
    """One file; ids come in any portions, documents in order."""

    def __init__(self, stream):
        self.stream, self.place, self.rest = stream, 0, np.zeros(0, np.uint32)
        self.starts: list[int] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.place += len(data)

    def _blocks(self, ids: np.ndarray) -> None:
        blocks = encode_blocks(ids)
        for block in blocks:
            self.starts.append(self.place)
            self.place += len(block)
        self.stream.write(b"".join(blocks))

    def add(self, has_id: np.ndarray, doc_id: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((has_id, doc_id, sizes))
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def close(self) -> tuple[int, int]:
        self._blocks(self.rest)
        has_id, doc_id, sizes = (np.concatenate(x) for x in zip(*self.docs)) if self.docs else (np.zeros(0),) * 3
        index = self.place
        self._put(np.array(self.starts, "<u8").tobytes())
        table = self.place
        self._put(has_id.astype("<u1").tobytes() + doc_id.astype("<i8").tobytes() + sizes.astype("<u8").tobytes())
        self._put(TRAILER.pack(index, table, len(self.starts), len(doc_id), int(sizes.sum())))
        self.stream.close()
        return len(doc_id), int(sizes.sum())


class Reader:
    """One file; reads the blocks asked for by the index."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        index, table, n_blocks, n_docs, self.n_ids = TRAILER.unpack(self._get(size - TRAILER.size, TRAILER.size))
        if self._get(0, 8) != MAGIC:
            raise ValueError("not a file of blocks")
        self.starts = np.append(np.frombuffer(self._get(index, 8 * n_blocks), "<u8"), np.uint64(index)).astype(np.int64)
        raw = self._get(table, 17 * n_docs)
        self.has_id = np.frombuffer(raw, "<u1", n_docs).astype(bool)
        self.doc_id = np.frombuffer(raw, "<i8", n_docs, n_docs)
        self.sizes = np.frombuffer(raw, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))

    def _get(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def blocks(self, i: int, j: int) -> np.ndarray:
        place = int(self.starts[i])
        return decode_blocks(self._get(place, int(self.starts[j]) - place), self.starts[i:j] - place) if j > i else np.zeros(0, np.uint32)

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document, from its own blocks only."""
        i, j = self.first[k] // BLOCK, -(-self.first[k + 1] // BLOCK)
        return self.blocks(i, j)[self.first[k] - i * BLOCK : self.first[k + 1] - i * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Documents i to j, not included, with all their ids, a bounded number at a time."""
        i = 0
        while i < len(self.sizes):
            j = max(i + 1, int(np.searchsorted(self.first, self.first[i] + RUN * BLOCK, "right")) - 1)
            low, high = self.first[i] // BLOCK, -(-self.first[j] // BLOCK)
            ids = self.blocks(low, high)
            yield i, j, ids[self.first[i] - low * BLOCK : self.first[j] - low * BLOCK]
            i = j


def _open(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system, place


def write_blocks(docs: DataFrame, folder: str, tokenizer: str, end_id: int, docs_per_file: int = 4096) -> DataFrame:
    """Encode every whole text and write the files; the manifest as a frame.

    docs: doc_id, text; other columns are not read. A null text is empty: its only id
    is ``end_id``. Null doc_ids come first. Equal doc_ids stand by text. An empty
    table gives no file. The manifest has a row per file: part, file, n_docs, n_ids;
    it is stored as ``folder``/manifest.
    """
    spark = docs.sparkSession
    bounds = id_bounds(docs, "doc_id", docs_per_file)
    system, place = _open(folder)
    system.create_dir(place, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, keeps_blanks=False)
        system, place = _open(folder)
        system.create_dir(place, recursive=True)
        part, name, writer = None, "", None

        def closed() -> pa.RecordBatch:
            n_docs, n_ids = writer.close()
            return pa.RecordBatch.from_pylist([{"part": part, "file": f"{folder}/{name}", "n_docs": n_docs, "n_ids": n_ids}], MANIFEST)

        for batch in batches:
            for piece in parts(batch, size=16 << 20):
                ids, first = encoder.encode(piece.column("text"))
                sizes = np.diff(first)
                ends = np.insert(ids, first[1:], np.uint32(end_id))
                first = first + np.arange(len(first))
                codes = piece.column("part").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
                for i, j in zip(cuts, cuts[1:]):
                    if codes[i] != part:
                        if writer:
                            yield closed()
                        part, name = int(codes[i]), f"part-{codes[i]:07d}-{uuid.uuid4().hex}.ids"
                        writer = Writer(system.open_output_stream(f"{place}/{name}"))
                    column = piece.column("doc_id").slice(i, j - i)
                    writer.add(
                        column.is_valid().to_numpy(zero_copy_only=False),
                        column.fill_null(0).to_numpy(),
                        sizes[i:j] + 1,
                        ends[first[i] : first[j]],
                    )
        if writer:
            yield closed()

    manifest = (
        docs.select(range_of("doc_id", bounds).alias("part"), F.col("doc_id").cast("long"), "text")
        .repartition(len(bounds) + 1, "part")
        .sortWithinPartitions("part", "doc_id", "text")
        .mapInArrow(write, "part int, file string, n_docs long, n_ids long")
    )
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_blocks(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. The driver adds up one
    number per file; ids are decoded where the file's task runs.
    """
    spark = manifest.sparkSession
    files, total = [], 0
    for row in manifest.orderBy("part").toLocalIterator():
        files.append((row.file, total))
        total += row.n_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, place = _open(file)
                with system.open_input_file(place) as source:
                    reader = Reader(source)
                    for i, j, ids in reader.documents():
                        raw = memoryview(ids.astype("<u4").tobytes())
                        at = (reader.first[i : j + 1] - reader.first[i]) * 4
                        crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_id[i:j], mask=~reader.has_id[i:j]),
                                pa.array(base + reader.first[i:j]),
                                pa.array(reader.sizes[i:j]),
                                pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    frame = spark.createDataFrame(files, "file string, base long")
    return frame.repartition(max(1, len(files))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_blocks(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Write all documents' ids as files of blocks, read them back, describe each document."""
    return read_blocks(write_blocks(docs, folder or new_path(spark, "token-blocks"), tokenizer, end_id))


def to_bytes(ids: np.ndarray) -> bytes:
    """A file of one document without id, for tests and small uses."""
    stream = io.BytesIO()
    stream.close, close = (lambda: None), stream.close
    writer = Writer(stream)
    writer.add(np.zeros(1, bool), np.zeros(1, np.int64), np.array([len(ids)]), ids.astype(np.uint32))
    writer.close()
    return stream.getvalue()
