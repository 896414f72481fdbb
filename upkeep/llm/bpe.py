"""Byte-pair encoding by speculation and check, and decoding.

Greedy longest match proposes the tokens of every distinct word. A proposal is what
merging would give if and only if no two neighbours would have exchanged symbols
across their border, so all adjacent pairs are tested at once by numpy. Only words
with a failing pair are merged exactly.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.tokens import REMEMBERED, Encoder
from upkeep.llm.words import parts

# White space as the tokenizers library sees it, the pattern of its
# byte-level step, and that step's rule for showing bytes as characters.
WHITE = "\t-\r \x85\xa0  -     　"
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def shown_bytes() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Bpe:
    """A byte-level BPE model in the JSON format of the tokenizers library.

    Normalizers NFC, white-space replacement and lower case, a split pattern or the
    byte-level one, a word-end suffix and special tokens are understood.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        kinds = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
        self.compose, self.lower = "NFC" in kinds, "Lowercase" in kinds
        steps = (config["pre_tokenizer"] or {}).get("pretokenizers", [config["pre_tokenizer"]])
        pattern = next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), BYTE_LEVEL)
        self.keeps_blanks = all(s["type"] != "Split" for s in steps)
        pattern = pattern.replace(r"(?!\S)", f"(?![^{WHITE}])").replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
        self.words = regex.compile(pattern)
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.shown = str.maketrans({b: c for b, c in enumerate(shown_bytes())})
        self.byte_decoder = (config.get("decoder") or {}).get("type") == "ByteLevel"

        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.rank = np.full(size, -1, np.int64)  # -1: not made by merging
        self.left, self.right = np.arange(size), np.arange(size)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            i, j, k = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merges.setdefault((i, j), (r, k))
            if self.rank[k] < 0:
                self.rank[k], self.left[k], self.right[k] = r, i, j
        keys = np.array([i << 32 | j for i, j in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.tokens = [""] * size
        for token, k in [*self.vocab.items(), *self.special.items()]:
            self.tokens[k] = token
        # Greedy match may only propose tokens that merging can arrive at.
        own = self.compatible(self.left, self.right, self.rank) & ((self.rank < 0) | (self.rank[self.left] < self.rank) & (self.rank[self.right] < self.rank))
        for k in np.argsort(self.rank, kind="stable"):
            own[k] &= own[self.left[k]] & own[self.right[k]]
        self.usable = {t: k for t, k in self.vocab.items() if own[k]}
        self.longest = max(len(t.removesuffix(self.suffix)) for t in self.usable)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether merging keeps each pair of neighbours apart (before the merge of rank ``limit``).

        Going back in time, the tokens at the border are taken apart, the younger one
        first. Two that stood side by side must not have a merge that comes before
        what was done to either of them; of equal merges the one further left is done first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        late = np.iinfo(np.int64).max
        end_a = np.full(len(a), late) if limit is None else np.where(limit < 0, late, limit)
        end_b = end_a.copy()
        fine = np.ones(len(a), bool)
        live = np.arange(len(a)) if limit is None else np.flatnonzero(limit >= 0)
        while len(live):
            x, y = a[live], b[live]
            key = x << 32 | y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            r = np.where(self.keys[at] == key, self.ranks[at], late)
            own = (r == end_a[live]) & (r == end_b[live]) if limit is not None else False
            bad = (r < end_a[live]) & (r <= end_b[live]) & ~np.asarray(own)
            fine[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            step_x = rx > ry
            more = ~bad & ((rx >= 0) | (ry >= 0))
            i, j = live[more & step_x], live[more & ~step_x]
            end_a[i], a[i] = self.rank[a[i]], self.right[a[i]]
            end_b[j], b[j] = self.rank[b[j]], self.left[b[j]]
            live = live[more]
        return fine

    def propose(self, word: str) -> list[int]:
        """Tokens of a word by greedy longest match; empty if there is none."""
        out, i, n = [], 0, len(word)
        usable, suffix = self.usable, self.suffix
        while i < n:
            j = min(n, i + self.longest)
            while j > i:
                token = usable.get(word[i:j] + suffix if j == n else word[i:j])
                if token is not None:
                    break
                j -= 1
            if j == i:
                return []
            out.append(token)
            i = j
        return out

    def merge(self, word: str) -> list[int]:
        """Tokens of a word by merging in order of rank, leftmost first."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + self.suffix]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            found = merges.get((ids[i], ids[j])) if j < n else None
            if found is None or found[0] != r:
                continue
            ids[i], ids[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (ids[i], ids[k]) in merges:
                    heapq.heappush(heap, (merges[ids[i], ids[k]][0], i))
            h = before[i]
            if h >= 0 and (ids[h], ids[i]) in merges:
                heapq.heappush(heap, (merges[ids[h], ids[i]][0], h))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Tokens of distinct words: proposed, checked pair by pair, merged where it failed."""
        found = [self.propose(word) for word in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for ids in found for t in ids), np.int64, int(size.sum()))
        failed = size == 0
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), size)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, back = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
            fine = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back]
            failed[owner[inner[~fine]]] = True
        for i in np.flatnonzero(failed):
            found[i] = self.merge(words[i])
        return found

    def split(self, text: str) -> list[str | int]:
        """Words of a text in byte-level characters, and ids of special tokens."""
        out: list[str | int] = []
        for piece in self.cut.split(text) if self.cut and "<" in text else (text,):
            if piece in self.special:
                out.append(self.special[piece])
                continue
            if self.compose and not piece.isascii():
                piece = unicodedata.normalize("NFC", piece)
            if self.lower:
                piece = piece.replace("Σ", "σ").lower()  # the library does not know the final sigma
            for word in self.words.findall(piece):
                out.append(word.translate(self.shown) if word.isascii() else word.encode().decode("latin-1").translate(self.shown))
        return out

    def decode(self, ids: list[int]) -> bytes:
        """As the library's decode with special tokens kept; the text in UTF-8."""
        tokens = self.shown_tokens
        if not self.byte_decoder:
            return b" ".join(map(tokens.__getitem__, ids))
        return b"".join(map(tokens.__getitem__, ids)).decode(errors="replace").encode()

    @functools.cached_property
    def shown_tokens(self) -> list[bytes]:
        if not self.byte_decoder:
            return [t.encode() for t in self.tokens]
        back = {c: bytes([b]) for b, c in enumerate(shown_bytes())}
        return [b"".join(back.get(c, c.encode()) for c in t) for t in self.tokens]


@functools.lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


_KNOWN: dict[str, dict[str, bytes]] = {}


def encode_units(path: str, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, and the n + 1 places where each unit's ids begin."""
    model = load(path)
    known = _KNOWN.setdefault(path, {})
    found = [known.get(unit) for unit in units]
    missing = [i for i, ids in enumerate(found) if ids is None]
    split = [model.split(units[i]) for i in missing]
    words = list({w: None for unit in split for w in unit if isinstance(w, str)})
    coded = {w: np.asarray(ids, np.uint32).tobytes() for w, ids in zip(words, model.encode_words(words))}
    for i, unit in zip(missing, split):
        found[i] = b"".join([coded[w] if isinstance(w, str) else np.uint32(w).tobytes() for w in unit])
        if len(known) < REMEMBERED and len(units[i]) < 100:
            known[units[i]] = found[i]
    places = np.zeros(len(units) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=places[1:])
    return np.frombuffer(b"".join(found), np.uint32), places


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, ids (array of int), decoded (string).

    Whole texts; a null or empty text has no ids and decodes to an empty text. Rows
    are taken one by one, so repeated rows and null doc_ids stay as they are; other
    columns are not read. Nothing is shuffled.
    """
    return docs.select("doc_id", "text").mapInArrow(_rows(path, _full), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 of the same results."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_rows(path, _digest), schema)


def _full(model: Bpe, ids: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    rows = [model.decode(ids[a:b].tolist()).decode() for a, b in zip(first, first[1:])]
    return {"ids": pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))), "decoded": pa.array(rows, pa.string())}


def _digest(model: Bpe, ids: np.ndarray, first: np.ndarray) -> dict[str, pa.Array]:
    raw = memoryview(ids.astype("<u4").tobytes())
    ends = first.tolist()
    decoded = [hashlib.sha256(model.decode(ids[a:b].tolist())).hexdigest() for a, b in zip(ends, ends[1:])]
    coded = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(ends, ends[1:])]
    return {"n_tokens": pa.array(np.diff(first)), "ids_sha256": pa.array(coded, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}


def _rows(path: str, result):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        encoder = Encoder(path, model.keeps_blanks, encode_units)
        for batch in batches:
            for piece in parts(batch, size=16 << 20):
                ids, first = encoder.encode(piece.column("text"))
                yield pa.RecordBatch.from_pydict({"doc_id": piece.column("doc_id"), **result(model, ids, first)})

    return run
