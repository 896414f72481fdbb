"""Byte-level BPE by rank files: encoding by backtracking from longest matches, and decoding.

Bytes are taken as Latin-1 characters, so that one Aho-Corasick automaton finds the
longest token at every place of a piece in one pass. From left to right the longest
token is taken that is compatible with the one before it, that is, merging the bytes
of both gives just these two. Where none is, the last token is given up for a shorter
one and the place it ended at is never tried again, so the work is linear in the
bytes. A row of tokens whose neighbours are all compatible is what merging gives.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from itertools import chain, islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.bpe import WHITE
from upkeep.llm.words import parts

#: Pieces whose ids a worker remembers, and bytes of the longest of them.
REMEMBERED, LONGEST = 400_000, 100
#: Pairs of tokens whose compatibility a worker remembers.
PAIRS = 2_000_000
#: Pieces of a text worked on at once.
STEP = 1 << 16


class RankBpe:
    """The ranks of a file (base64 token and rank per line) and a pattern that splits texts.

    A piece that is a token is that token. Otherwise the neighbours whose joint bytes
    have the least rank are merged, the leftmost first, until no two have any.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        lacking = [b for b in range(256) if bytes([b]) not in self.ranks]
        if lacking:
            raise ValueError(f"no token for the bytes {lacking}")
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.size = np.array([len(t) for t in self.bytes_of])
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        white = pattern.replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
        self.pattern = regex.compile(white)
        self.automaton = ahocorasick.Automaton()
        self.length: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for token, rank in self.ranks.items():
            made = self.merge(token, 2)
            if len(made) == 2:
                self.halves[rank] = made[0], made[1]
            elif made != [rank]:
                continue  # never arrived at inside a piece
            self.automaton.add_word(token.decode("latin-1"), rank)
            self.length[rank] = len(token)
        self.automaton.make_automaton()
        self.shorter = {rank: self._shorter(self.bytes_of[rank]) for rank in self.length}
        self.known = Known(self)
        self.pairs: dict[tuple[int, int], bool] = {}

    def _shorter(self, token: bytes) -> int:
        """The longest usable token that ``token`` begins with, itself left out; -1 if none."""
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end], -1)
            if rank in self.length:
                return rank
        return -1

    def merge(self, piece: bytes, least: int = 1) -> list[int]:
        """Merging itself, until ``least`` tokens are left; for tokens and pairs of them,
        as its time is the square of the length."""
        ranks, none = self.ranks, len(self.bytes_of)
        tokens = [piece[i : i + 1] for i in range(len(piece))]
        joint = [ranks.get(a + b, none) for a, b in zip(tokens, tokens[1:])]
        while len(tokens) > least and (first := min(joint)) < none:
            i = joint.index(first)
            tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
            del joint[i]
            if i:
                joint[i - 1] = ranks.get(tokens[i - 1] + tokens[i], none)
            if i < len(joint):
                joint[i] = ranks.get(tokens[i] + tokens[i + 1], none)
        return [ranks[t] for t in tokens]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives these two."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self._kept_apart(left, right)
        return found

    def _kept_apart(self, left: int, right: int) -> bool:
        """No two parts that met at the border would have been merged with each other.

        Back in time, of the two parts at the border the later one is taken apart. They
        are merged if their joint rank comes before what was done to either; of equal
        ranks the one further left comes first.
        """
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self.halves
        none = len(bytes_of)
        left_end = right_end = none + 1
        while True:
            joint = ranks.get(bytes_of[left] + bytes_of[right], none)
            if joint < none and joint < left_end and joint <= right_end:
                return False
            left_made = left if left in halves else -1
            right_made = right if right in halves else -1
            if left_made > right_made:
                left_end, left = left, halves[left][1]
            elif right_made >= 0:
                right_end, right = right, halves[right][0]
            else:
                return True

    def backtrack(self, piece: bytes) -> list[int]:
        """Tokens of a piece that is no token itself."""
        longest = [-1] * len(piece)
        length, shorter, compatible = self.length, self.shorter, self.compatible
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # of one start, longer ones come later
        alive = bytearray(b"\1") * (len(piece) + 1)
        out: list[int] = []
        place, token = 0, longest[0]
        while place < len(piece):
            while token >= 0:
                end = place + length[token]
                if alive[end] and (not out or compatible(out[-1], token)):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                place = end
                token = longest[place] if place < len(piece) else -1
            else:
                alive[place] = 0
                given_up = out.pop()
                place -= length[given_up]
                token = shorter[given_up]
        return out

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        rank = self.ranks.get(raw)
        return (rank,) if rank is not None else tuple(self.backtrack(raw))

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, a list for each ``STEP`` pieces."""
        if len(text) <= STEP:
            yield list(chain.from_iterable(map(self.known.__getitem__, self.pattern.findall(text))))
            return
        pieces = (match[0] for match in self.pattern.finditer(text))
        while some := list(islice(pieces, STEP)):
            yield list(chain.from_iterable(map(self.known.__getitem__, some)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class Known(dict):
    """Ids of pieces met before; long ones are never kept."""

    def __init__(self, model: RankBpe):
        super().__init__()
        self.model = model

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.model.encode_piece(piece)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str) -> RankBpe:
    return RankBpe(path, pattern)


def encode_and_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, ids (array of int), decoded (binary).

    docs: doc_id, text; other columns are not read, whatever their names. Whole texts; a
    null or empty text has no ids and decodes to no bytes, and an empty table gives an
    empty one. Rows are taken one by one, so repeated rows, one doc_id on different
    texts and null doc_ids stay as they are. Texts are worked on in steps, so a very
    long one takes memory for its ids only. Nothing is shuffled.
    """

    def full(model: RankBpe, text: str) -> dict[str, object]:
        found = list(model.encode(text))
        return {"ids": list(chain.from_iterable(found)), "decoded": b"".join(map(model.decode, found))}

    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])
    return _over(docs, path, pattern, full, schema, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (of decimal ids joined by blanks),
    decoded_sha256 (of the bytes that the ids decode to).

    Rows as in ``encode_and_decode``; of a very long text only a step is held.
    """

    def digest(model: RankBpe, text: str) -> dict[str, object]:
        n, coded, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for ids in model.encode(text):
            coded.update(((" " if n and ids else "") + " ".join(map(model.decimal.__getitem__, ids))).encode())
            decoded.update(model.decode(ids))
            n += len(ids)
        return {"n_tokens": n, "ids_sha256": coded.hexdigest(), "decoded_sha256": decoded.hexdigest()}

    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return _over(docs, path, pattern, digest, schema, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _over(docs: DataFrame, path: str, pattern: str, result, schema: pa.Schema, ddl: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path, pattern)
        for batch in batches:
            for piece in parts(batch):
                ids = piece.column("doc_id").to_pylist()
                rows = [{"doc_id": i, **result(model, text or "")} for i, text in zip(ids, piece.column("text").to_pylist())]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, ddl)
