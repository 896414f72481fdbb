"""Language of a text by error-correcting output codes.

Every language has a codeword; a binary classifier over hashed letter n-grams predicts
each bit. The codeword with the smallest total loss over the bits wins, where a bit
counts by how sure its classifier is. A text is flagged as ambiguous if more bits are
wrong than the code can correct, or if the next codeword is nearly as near.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.store import returning
from upkeep.llm.words import buffers, parts

FEATURES = 1 << 15
GRAMS = (2, 3)
#: Labelled rows of a language the classifiers learn from, at most.
TRAIN_ROWS = 50_000
#: n-grams of a text are not independent: more than these do not make the evidence stronger.
EVIDENCE = 100
UNKNOWN = "und"
#: The next codeword's loss must be larger by this, else the text is ambiguous.
CLEAR = np.log(3)

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]


def codewords(n: int) -> np.ndarray:
    """(n, bits) of 0 and 1: all dichotomies up to 7 languages, else the best of random codes."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        columns = [[int(i == 0 or (c >> (i - 1)) & 1) for i in range(n)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    random = np.random.RandomState(n)
    bits = int(np.ceil(10 * np.log2(n)))
    best, reach = None, -1
    for _ in range(200):
        code = random.randint(0, 2, (n, bits)).astype(np.int8)
        code = code[:, (code.sum(axis=0) > 0) & (code.sum(axis=0) < n)]
        if distance(code) > reach:
            best, reach = code, distance(code)
    return best


def distance(code: np.ndarray) -> int:
    """Smallest Hamming distance of two codewords."""
    return min((int((a != b).sum()) for a, b in combinations(code, 2)), default=0)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of letters, one value per place, and the n + 1 numbers of the
    texts' first. Other signs count as blanks; n-grams of blanks are value 0."""
    data, offsets = buffers(pc.utf8_lower(texts))
    letters = _LETTER[data].astype(np.uint32)
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    end = np.repeat(offsets[1:], np.diff(offsets))
    place = np.arange(len(letters))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for n in GRAMS:
        size = max(0, len(letters) - n + 1)
        code = np.zeros(size, np.uint32)
        blank = np.ones(size, bool)
        for j in range(n):
            code = code * np.uint32(257) + letters[j : j + size]
            blank &= letters[j : j + size] == 0x20
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(17)
        code = np.where(blank, 0, 1 + code % np.uint32(FEATURES - 1)).astype(np.int32)
        inside = place[:size] + n <= end[:size]
        found.append((code[inside], text[:size][inside]))
        counts += np.bincount(found[-1][1], minlength=len(counts))
    code, text = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(text, kind="stable")
    return code[order], np.concatenate(([0], np.cumsum(counts)))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (bits, FEATURES) log odds of a set bit

    def predict(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language, score, whether ambiguous, wrong bits, of each text."""
        n, bits = len(texts), self.code.shape[1]
        if not bits:
            return np.zeros(n, int), np.ones(n), np.zeros(n, bool), np.zeros(n, int)
        code, first = features(texts)
        some = np.flatnonzero(np.diff(first) > 0)
        known = np.add.reduceat((code > 0).astype(np.int64), first[some]) if len(some) else np.zeros(0)
        margin = np.zeros((n, bits))
        for b in range(bits):
            if len(some):
                total = np.add.reduceat(self.weights[b][code], first[some], dtype=np.float64)
                margin[some, b] = total / np.maximum(1, known) * np.minimum(known, EVIDENCE)
        sign = 2.0 * self.code - 1
        loss = np.stack([np.logaddexp(0, -margin * s).sum(axis=1) for s in sign], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        least = loss[np.arange(n), best]
        chance = np.exp(least[:, None] - loss)
        score = 1 / chance.sum(axis=1)
        wrong = ((margin > 0) != (self.code[best] > 0)).sum(axis=1)
        clear = loss[np.arange(n), order[:, 1]] - least >= CLEAR
        correctable = (distance(self.code) - 1) // 2
        return best, score, ~clear | (wrong > correctable), wrong


def learn(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Binary classifiers (naive Bayes log odds) from text and lang of docs.

    Rows with null text or lang teach nothing. Of a language with more than ``rows``
    rows a share is taken by a hash of the text. The driver gets the number of rows of
    each language and ``FEATURES`` counts of each.
    """
    spark = docs.sparkSession
    taught = docs.where("lang is not null and text is not null").select("lang", "text")
    held = {r["lang"]: r["count"] for r in taught.groupBy("lang").count().collect()}
    languages = sorted(held)
    shares = {x: min(1.0, rows / held[x]) for x in languages}
    if any(s < 1 for s in shares.values()):
        share = F.create_map(*[F.lit(v) for pair in shares.items() for v in pair])[F.col("lang")]
        taught = taught.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in parts(batch):
                code, first = features(piece.column("text"))
                owner = np.repeat(np.arange(piece.num_rows), np.diff(first))
                lang = piece.column("lang").to_pylist()
                for x in set(lang):
                    mine = np.array([y == x for y in lang])
                    totals[x] = totals.get(x, 0) + np.bincount(code[mine[owner]], minlength=FEATURES)
        for x, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])], ["lang", "feature", "n"])

    counts = taught.mapInArrow(returning(count), "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = np.zeros((len(languages), FEATURES))
    number = {x: i for i, x in enumerate(languages)}
    if languages:
        got = counts.toPandas()
        table[got["lang"].map(number).to_numpy(int), got["feature"].to_numpy(int)] = got["n"]
    table[:, 0] = 0
    share = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * FEATURES)
    code = codewords(len(languages))
    weights = np.zeros((code.shape[1], FEATURES), np.float32)
    for b, column in enumerate(code.T):
        weights[b] = np.log(share[column == 1].mean(axis=0)) - np.log(share[column == 0].mean(axis=0))
        weights[b, 0] = 0
    return Model(languages, code, weights)


RESULT = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_()), ("wrong_bits", pa.int32())])


def identify(docs: DataFrame, model: Model, column: str = "language") -> DataFrame:
    """docs with a struct ``column`` of lang_pred, score, ambiguous, wrong_bits; all rows
    and columns stay.

    A text that is null or has no letter is ``und`` with score 0 and ambiguous; so is
    every text if no language was learned. With one language learned all others are
    that, with score 1. Only the text decides, and only the text is handed to Python, in
    parts of a megabyte, a longer text being one; equal scores go to the language that
    comes first. Repeated rows and null ids stay as they are, and an empty table is
    empty. A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = shared.value
        for texts, letters in batches:
            batch = pa.RecordBatch.from_arrays([texts, letters], ["text", "letters"])
            found = [judged(model, piece) for piece in parts(batch)]
            yield pa.concat_arrays(found) if found else pa.array([], RESULT)

    kind = "struct<lang_pred: string, score: double, ambiguous: boolean, wrong_bits: int>"
    judge = F.arrow_udf(returning(run), kind).asNondeterministic()  # else a filter would run it again
    letters = F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False))
    return docs.drop(column).withColumn(column, judge("text", letters))


def judged(model: Model, piece: pa.RecordBatch) -> pa.StructArray:
    n = piece.num_rows
    known = piece.column("letters").to_numpy(zero_copy_only=False) & bool(model.languages)
    if model.languages:
        best, score, ambiguous, wrong = model.predict(piece.column("text"))
    else:
        best, score, ambiguous, wrong = np.zeros(n, int), np.zeros(n), np.ones(n, bool), np.zeros(n, int)
    lang = [model.languages[i] if k else UNKNOWN for i, k in zip(best, known)]
    return pa.StructArray.from_arrays(
        [pa.array(lang, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(ambiguous | ~known), pa.array(wrong, pa.int32())],
        fields=list(RESULT),
    )


def held_out(column: str = "doc_id"):
    """Whether a document is kept from learning; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """Learn from two thirds of docs by their ids, predict all: doc_id, held_out,
    lang_pred, score, ambiguous, wrong_bits. Rows without doc_id teach nothing."""
    model = learn(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "language.*")
