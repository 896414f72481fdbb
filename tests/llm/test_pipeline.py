import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from tests.llm.data import CLASHES, documents, odd_rows, prose
from tests.llm.test_near_copies import classes, edited
from tests.llm.test_others import ALPHABETS
from upkeep.llm.queries import QUERIES
from upkeep.llm.tokens import tokenizer


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, copies, near copies, shared passages, texts without letters."""
    names = sorted(ALPHABETS)
    rows = [(i, prose(i, 80 + i % 40, ALPHABETS[names[i % 4]]), names[i % 4]) for i in range(80)]
    passage = prose(999, 60, ALPHABETS["aa"])
    rows += [(100 + i, rows[i][1], rows[i][2]) for i in range(5)]
    rows += [(110 + i, edited(rows[10 + i][1], i, 0.01), rows[10 + i][2]) for i in range(5)]
    rows += [(120 + i, f"{prose(2000 + i, 50, ALPHABETS['aa'])} {passage} {prose(3000 + i, 50, ALPHABETS['aa'])}", "aa") for i in range(4)]
    rows += [(130, "12345 67890"), (131, None), (132, ""), (133, passage, "aa")]
    folder = tmp_path_factory.mktemp("corpus")
    documents(spark, rows, ["extra"]).write.parquet(f"{folder}/documents.parquet")
    return str(folder), rows, passage


def test_stages(spark, corpus):
    folder, rows, passage = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_passages", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        steps[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    assert {r.doc_id for r in steps["language"]} == {i for i, *_ in rows} - {130, 131, 132}
    kept = {r.doc_id: r.text for r in steps["language"]}
    first = classes(list(kept.items()))
    assert {r.doc_id for r in steps["near_duplicates"]} == {i for i, c in first.items() if i == c}
    after = {r.doc_id: r for r in steps["repeated_passages"]}
    assert passage in after[120].text
    for i in (121, 122, 123):
        assert passage not in after[i].text
        assert after[i].n_chars == len(after[i].text)
        assert re.findall(r"\w+", after[i].text)[:50] == re.findall(r"\w+", kept[i])[:50]
    assert 133 not in after
    assert all(after[i].text == kept[i] for i in after if i < 80)
    library = tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    packed = defaultdict(int)
    for r in steps["packing"]:
        packed[r.doc_id] += r.length
    assert packed == {i: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in after.items()}


def test_run_is_the_stages_in_turn(spark, corpus):
    folder, _, _ = corpus
    got = corpus_pipeline.run(spark, folder)
    total = Counter()
    for r in got.collect():
        total[r.sequence_id] += r.length
    assert max(total.values()) <= corpus_pipeline.SEQUENCE
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_stages_take_odd_rows_and_none(spark, tmp_path):
    for k, rows in enumerate((odd_rows(), [])):
        documents(spark, rows, CLASHES).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        docs = spark.read.parquet(f"{tmp_path}/{k}/documents.parquet")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stage(spark, docs, f"{tmp_path}/{k}")
            assert docs.columns == columns
        if rows:
            ids = sorted(r.doc_id or 0 for r in docs.collect())
            assert ids == [0, 0, 1, 2, 3, 4, 5, 6, 7, 9, 11, 12, 13, 14]
        corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()


def test_every_operator_has_its_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
