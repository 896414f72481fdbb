"""Token ids of whole Arrow columns of text by the tokenizers library.

A text is cut into units whose tokens do not depend on what surrounds them, equal
units of a batch are encoded once, and ids are put together by numpy. Texts for
which such a cut is not certain are encoded whole.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units encoded by one call; a special token stands between them.
GROUP = 500


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


#: Units whose ids a worker remembers from one batch to the next, at most, and characters
#: of the longest: a text encoded whole is a unit too, and would hardly come again.
REMEMBERED, LONGEST = 400_000, 100
_KNOWN: dict[str, dict[str, bytes]] = {}
# The splits of tokenizers that encode letters and the signs after them apart.
WORDS_AND_SIGNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
ONE_WORD = re.compile(r"[a-z]+|[!-&(-/:-@\[-`{-~]+")


def encode_units(path: str, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all units, and the n + 1 places where each unit's ids begin."""
    known = _KNOWN.setdefault(path, {})
    found = [known.get(unit) for unit in units]
    missing = [i for i, ids in enumerate(found) if ids is None]
    for i, ids in zip(missing, _encode(path, [units[i] for i in missing])):
        found[i] = ids
        if len(known) < REMEMBERED and len(units[i]) <= LONGEST:
            known[units[i]] = ids
    places = np.zeros(len(units) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4, out=places[1:])
    return np.frombuffer(b"".join(found), np.uint32), places


def forget() -> None:
    """Give up what a task's encoders have remembered: units, and the tokenizers themselves."""
    _KNOWN.clear()
    for cached in (tokenizer, splits_letters, borders):
        cached.cache_clear()


@functools.lru_cache(maxsize=4)
def splits_letters(path: str) -> tuple[bool, bool]:
    """Whether the tokenizer keeps letters apart from signs, and whether it lowers case."""
    config = json.loads(tokenizer(path).to_str())
    lower = "Lowercase" in [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
    step = config["pre_tokenizer"] or {}
    steps = step.get("pretokenizers", [step])
    words = any(s.get("type") == "Split" and s["pattern"].get("Regex") == WORDS_AND_SIGNS for s in steps)
    bytes_ = len(steps) == 1 and step.get("type") == "ByteLevel" and step.get("use_regex")
    return lower and words or not lower and bool(bytes_), lower


def cut_units(units: pa.Array, lower: bool) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Letters (with a blank before them) and signs of each unit, and which units are such."""
    shown = pc.utf8_lower(units) if lower else units
    signs = "".join("\\" + c for c in SIGNS)
    simple = pc.and_(pc.string_is_ascii(units), pc.match_substring_regex(shown, f"^ ?[A-Za-z]+[{signs}]*$"))
    return pc.utf8_rtrim(shown, SIGNS), pc.utf8_ltrim(shown, " " + LETTERS), simple.to_numpy(zero_copy_only=False)


def _encode(path: str, units: list[str]) -> list[bytes]:
    """Ids of each unit. Units whose tokens show where they begin or end are encoded
    many at a time side by side, the others with a special token between them."""
    library = tokenizer(path)
    out: list[bytes] = [b""] * len(units)
    whole, first = borders(path)
    if first:  # a blank before each unit, and none elsewhere
        beside = [i for i, u in enumerate(units) if u[:1] == " " and len(u) > 1 and not u[1].isspace() and not u[-1].isspace() and "<|" not in u]
        glue = ""
    elif splits_letters(path)[0]:  # a unit of letters or of signs is one word
        beside = [i for i, u in enumerate(units) if ONE_WORD.fullmatch(u)]
        glue = " "
    else:
        beside, glue = [], ""
    left = set(range(len(units)))
    groups = [beside[k : k + GROUP] for k in range(0, len(beside), GROUP)]
    for group, found in zip(groups, library.encode_batch_fast([glue.join([units[i] for i in g]) for g in groups], add_special_tokens=False)):
        got = np.asarray(found.ids, np.uint32)
        cuts = np.flatnonzero(whole[got]) * 4 if first else (np.flatnonzero(whole[got]) + 1) * 4
        if len(cuts) != len(group):
            continue
        cuts = [*cuts.tolist(), 4 * len(got)] if first else [0, *cuts.tolist()]
        raw = got.tobytes()
        for i, a, b in zip(group, cuts, cuts[1:]):
            out[i] = raw[a:b]
        left.difference_update(group)

    mark = "<|endoftext|>"
    stop = library.token_to_id(mark)
    plain = [i for i in sorted(left) if "<|" not in units[i]]
    odd = [i for i in sorted(left) if "<|" in units[i]]
    groups = [plain[k : k + GROUP] for k in range(0, len(plain), GROUP)]
    for group, found in zip(groups, library.encode_batch_fast([mark.join([units[i] for i in g]) for g in groups], add_special_tokens=False)):
        got = np.append(np.asarray(found.ids, np.uint32), np.uint32(stop))
        ends = np.flatnonzero(got == stop) * 4
        raw, start = got.tobytes(), 0
        for i, end in zip(group, ends.tolist()):
            out[i], start = raw[start:end], end + 4
    for i, found in zip(odd, library.encode_batch_fast([units[i] for i in odd], add_special_tokens=False)):
        out[i] = np.asarray(found.ids, np.uint32).tobytes()
    return out


@functools.lru_cache(maxsize=4)
def borders(path: str) -> tuple[np.ndarray, bool]:
    """Which ids are tokens that begin with a blank (then true), or that end a word."""
    library = tokenizer(path)
    suffix = json.loads(library.to_str())["model"].get("end_of_word_suffix")
    marked = np.zeros(library.get_vocab_size(), bool)
    for token, i in library.get_vocab().items():
        marked[i] = token.endswith(suffix) if suffix else token.startswith("Ġ")
    return marked, not suffix


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., one run of ``size`` numbers for each start."""
    total = int(size.sum())
    return np.arange(total) + np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) if total else np.zeros(0, np.int64)


def joined(values: np.ndarray, places: np.ndarray, unit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the units in turn, and where those of each text begin.

    ``first`` has the n + 1 numbers of the texts' first units.
    """
    size = np.diff(places)[unit]
    ends = np.concatenate(([0], np.cumsum(size)))
    return values[ranges(places[unit], size)], ends[first]


#: Where the library and Arrow may see white space differently, or a special token may stand.
ODD = "[\\x1c-\\x1f\\x{85}\\x{180e}\\x{200b}\\x{2060}\\x{feff}]|<\\|"
#: A run of white space with a blank in it is a unit of its own kind.
WIDE = "\\t\\n\\x0b\\x0c\\r\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
SPACED = f" [ {WIDE}]|[{WIDE}] "


def blank_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units between white space, for tokenizers that drop it."""
    found = pc.utf8_split_whitespace(texts)
    return found.values.slice(found.offsets[0].as_py(), found.offsets[-1].as_py() - found.offsets[0].as_py()), np.diff(found.offsets.to_numpy())


def spaced_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units that begin at each single blank and keep it, for tokenizers that keep it."""
    found = pc.split_pattern(texts, " ")
    flat = found.values.slice(found.offsets[0].as_py(), found.offsets[-1].as_py() - found.offsets[0].as_py())
    count = np.diff(found.offsets.to_numpy())
    head = np.zeros(len(flat), bool)
    head[(np.concatenate(([0], np.cumsum(count)[:-1])))[count > 0]] = True
    return pc.binary_join_element_wise(pc.if_else(pa.array(head), "", " "), flat, ""), count


class Encoder:
    """Ids of texts as the library's ``encode(text, add_special_tokens=False)``.

    ``keeps_blanks`` tells whether blanks are parts of tokens (byte-level) or dropped.
    """

    def __init__(self, path: str, keeps_blanks: bool, units=encode_units):
        self.path, self.keeps_blanks, self.units = path, keeps_blanks, units

    def distinct(self, units: pa.Array, whole: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units and of whole texts, in this order.

        Letters and signs recur more often than units of both, so they are looked up
        apart where the tokenizer encodes them apart.
        """
        splits, lower = splits_letters(self.path)
        if not splits:
            return self.units(self.path, [*units.to_pylist(), *whole])
        heads, tails, simple = cut_units(units, lower)
        mask = pa.array(simple)
        heads, tails = heads.filter(mask).dictionary_encode(), tails.filter(mask).dictionary_encode()
        others = [*units.filter(pc.invert(mask)).to_pylist(), *whole]
        ids, places = self.units(self.path, [*heads.dictionary.to_pylist(), *tails.dictionary.to_pylist(), *others])
        places = np.append(places, places[-1])  # one more piece, without ids
        n_heads, n_tails, none = len(heads.dictionary), len(tails.dictionary), len(places) - 2
        pieces = np.full((len(units) + len(whole), 2), none, np.int64)
        pieces[: len(units)][simple, 0] = heads.indices.to_numpy()
        pieces[: len(units)][simple, 1] = tails.indices.to_numpy() + n_heads
        rest = np.concatenate((np.flatnonzero(~simple), np.arange(len(whole)) + len(units)))
        pieces[rest, 0] = np.arange(len(rest)) + n_heads + n_tails
        return joined(ids, places, pieces.ravel(), 2 * np.arange(len(pieces) + 1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the n + 1 places where each one's begin; null is empty."""
        texts = texts.fill_null("").cast(pa.string())
        odd = pc.match_substring_regex(texts, f"{ODD}|{SPACED}" if self.keeps_blanks else ODD)
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        easy = np.flatnonzero(~odd.to_numpy(zero_copy_only=False))
        flat, count = (spaced_units if self.keeps_blanks else blank_units)(texts.take(pa.array(easy)))
        coded = flat.dictionary_encode()
        ids, places = self.distinct(coded.dictionary, texts.take(pa.array(whole)).to_pylist())
        unit = np.concatenate((coded.indices.to_numpy().astype(np.int64), np.arange(len(whole)) + len(coded.dictionary)))
        counts = np.concatenate((count, np.ones(len(whole), np.int64)))
        if not len(whole):
            return joined(ids, places, unit, np.concatenate(([0], np.cumsum(counts))))
        # Easy texts first, then the others: back to the order of the rows.
        ids, starts = joined(ids, places, unit, np.concatenate(([0], np.cumsum(counts))))
        order = np.argsort(np.concatenate((easy, whole)), kind="stable")
        size = np.diff(starts)[order]
        return ids[ranges(starts[:-1][order], size)], np.concatenate(([0], np.cumsum(size)))

