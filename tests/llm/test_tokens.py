import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.data import CLASHES, documents, odd_rows, prose
from upkeep.llm import blocks, bpe
from upkeep.llm.tokens import Encoder, tokenizer

NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = [
    "a  b", None, "", "x<|endoftext|>y z<|startoftext|>", " lead", "trail ", "a\n b", "a \n\n b", "tab\tz\x1cq\x85w", "it's they'll don't 'S",
    "x y z", "ΣΑΣ Σ İx", "a\n\nb c\nd", "<|endof", "aaaaaaaaaaaa" * 20, "é x", "123 4,5 !!!???...", "\U0001f600 hi", "x y 　 z",
]


def mixed(n=400):
    rng = random.Random(3)
    return ["".join(rng.choice("abcdeinorst' .é1-\nTHE") for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("name", NAMES)
def test_cut_encoding_is_the_library(name):
    path = public_tokenizers.path(name)
    encoder = Encoder(path, keeps_blanks=name.startswith("byte"))
    for texts in (ODD, mixed(), ODD):
        ids, first = encoder.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            assert ids[first[i] : first[i + 1]].tolist() == tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_speculation_is_the_library(name):
    path = public_tokenizers.path(name)
    model = bpe.load(path)
    encoder = Encoder(path, model.keeps_blanks, bpe.encode_units)
    for texts in (ODD, mixed()):
        ids, first = encoder.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            want = tokenizer(path).encode(text or "", add_special_tokens=False).ids
            got = ids[first[i] : first[i + 1]].tolist()
            assert got == want
            assert model.decode(got).decode() == tokenizer(path).decode(want, skip_special_tokens=False)


def test_checked_pairs_are_those_that_merging_keeps():
    model = bpe.load(public_tokenizers.path(NAMES[0]))
    rng = np.random.default_rng(0)
    inner = np.array([i for t, i in model.usable.items() if not t.endswith("</w>") and len(t) < 5])
    last = np.array([i for t, i in model.usable.items() if t.endswith("</w>") and len(t) < 9])
    a, b = rng.choice(inner, 3000), rng.choice(last, 3000)
    fine = model.compatible(a, b)
    assert 0 < fine.sum() < len(fine)
    for x, y, f in zip(a, b, fine):
        assert (model.merge(model.tokens[x] + model.tokens[y].removesuffix("</w>")) == [x, y]) == f


def test_bpe_of_odd_rows(spark):
    path = public_tokenizers.path(NAMES[0])
    rows = odd_rows()
    got = bpe.digests(documents(spark, rows, CLASHES), path).collect()
    want = []
    for doc_id, text in rows:
        ids = tokenizer(path).encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer(path).decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    full = bpe.encode_and_decode(documents(spark, [(1, "Hello there")]), path).first()
    assert tokenizer(path).decode(full.ids, skip_special_tokens=False) == full.decoded
    assert bpe.digests(documents(spark, []), path).collect() == []


@pytest.mark.parametrize(
    "ids",
    [
        [],
        [7],
        list(range(1000)),
        [2**32 - 1, 0] * 300,
        [5] * 700,
        [2**31 if i % 50 == 0 else i % 9 for i in range(5000)],
    ],
)
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    reader = blocks.Reader(pa.BufferReader(blocks.to_bytes(ids)))
    assert reader.document(0).tolist() == ids.tolist()


def test_exceptions_keep_blocks_narrow():
    few = np.where(np.arange(25600) % 100 == 0, 2**31, np.arange(25600) % 8).astype(np.uint32)
    assert len(blocks.to_bytes(few)) < 25600


def test_reader_takes_only_the_blocks_of_a_document():
    import io

    stream = io.BytesIO()
    stream.close = lambda: None
    writer = blocks.Writer(stream)
    ids = np.arange(5000, dtype=np.uint32)
    sizes = np.array([10, 0, 2000, 1, 2989])
    writer.add(np.ones(5, bool), np.arange(5), sizes, ids)
    writer.close()
    reader = blocks.Reader(pa.BufferReader(stream.getvalue()))
    ends = np.concatenate(([0], np.cumsum(sizes)))
    for k in range(5):
        assert reader.document(k).tolist() == ids[ends[k] : ends[k + 1]].tolist()


def described(rows, path, end):
    """What the files must hold, in order of id (null first) and text (null first)."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*tokenizer(path).encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("per_file", [3, 4096])
def test_token_blocks_of_odd_rows(spark, tmp_path, per_file):
    path = public_tokenizers.path(NAMES[0])
    rows = odd_rows()
    manifest = blocks.write_blocks(documents(spark, rows, CLASHES), f"file://{tmp_path}/ids", path, 2, per_file)
    got = sorted((tuple(r) for r in blocks.read_blocks(manifest).collect()), key=lambda r: r[1])
    assert got == described(rows, path, 2)
    assert manifest.count() == (1 if per_file == 4096 else manifest.count())


def test_token_blocks_of_no_rows(spark):
    assert blocks.token_blocks(spark, documents(spark, []), public_tokenizers.path(NAMES[0])).collect() == []


def test_token_blocks_of_many_ranges(spark):
    path = public_tokenizers.path(NAMES[0])
    rows = [(i * 7 % 200, prose(i, 3 + i % 40)) for i in range(200)]
    manifest = blocks.write_blocks(documents(spark, rows), blocks.new_path(spark, "many"), path, 2, 20)
    assert manifest.count() > 5
    assert sorted((tuple(r) for r in blocks.read_blocks(manifest).collect()), key=lambda r: r[1]) == described(rows, path, 2)


def test_ranges_of_ids_are_bounded_in_number(spark, monkeypatch):
    from upkeep.llm import store

    frame = spark.range(0, 100_000, 3).withColumnRenamed("id", "doc_id")
    assert len(store.id_bounds(frame, "doc_id", 100)) == 332
    monkeypatch.setattr(store, "MOST_RANGES", 150)
    bounds = store.id_bounds(frame, "doc_id", 100)
    assert len(bounds) == 149
    from pyspark.sql import functions as F

    number = store.range_of("doc_id", bounds)
    got = frame.select("doc_id", number.alias("n")).toPandas()
    want = np.searchsorted(np.array(bounds), got["doc_id"].to_numpy(), "right")
    assert (got["n"].to_numpy() == want).all()
    sizes = frame.groupBy(number.alias("n")).agg(F.count("*").alias("c")).toPandas()["c"]
    assert sizes.max() < 3 * sizes.min()


def test_long_units_are_not_remembered():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Encoder(path, keeps_blanks=True)
    texts = [prose(seed, 200) + "  " + prose(seed + 1, 5) for seed in range(900, 950)]  # encoded whole
    ids, first = encoder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == tokenizer(path).encode(text, add_special_tokens=False).ids
    from upkeep.llm import tokens

    assert max(map(len, tokens._KNOWN[path])) <= tokens.LONGEST
