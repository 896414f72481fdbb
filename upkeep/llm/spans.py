"""Spans of documents that repeat elsewhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.store import free_name, returning
from upkeep.llm.words import Words, parts


def code_points(words: Words, text: int, word: np.ndarray, ends: bool) -> np.ndarray:
    """Place of a text's words (their ends, if asked) in code points of the text.

    Lower case keeps the number of code points, so they hold for the text as it was.
    """
    low, high = words.offsets[text], words.offsets[text + 1]
    starts = np.cumsum((words.data[low:high] & 0xC0) != 0x80)
    at = words.first[text] + word
    if ends:
        return starts[words.end[at] - low - 1]
    return starts[words.start[at] - low] - 1


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (not included) of the runs of true."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def merged(spans: DataFrame) -> DataFrame:
    """Spans (doc_id, role, start, end, other) of a document and role, overlapping ones as one.

    ``other`` becomes the smallest. Equal spans are put together before the window, so
    it sees a document's different spans only.
    """
    distinct = spans.groupBy("doc_id", "role", "start", "end").agg(F.min("other").alias("other"))
    by = Window.partitionBy("doc_id", "role").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    opened = distinct.withColumn("new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    island = opened.withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        island.groupBy("doc_id", "role", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other"))
        .drop("island")
    )


def cut(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """docs without the spans (doc_id, start, end) in their texts; n_chars follows.

    Spans do not overlap. Documents left without a word are dropped. Rows without a
    span stay as they are.
    """
    mark = free_name(docs, "cuts")
    listed = copies.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias(mark))
    marked = docs.join(listed.hint("merge"), "doc_id", "left")
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for piece in parts(batch):
                yield shortened(piece)

    def shortened(piece):
        texts = piece.column("text").to_pylist()
        cuts = piece.column(mark).to_pylist()
        for i, spans in enumerate(cuts):
            if spans:
                text, at, rest = texts[i], 0, []
                for span in sorted(spans, key=lambda s: s["start"]):
                    rest.append(text[at : span["start"]])
                    at = span["end"]
                texts[i] = "".join([*rest, text[at:]])
        new = pa.array(texts, pa.string())
        keep = pa.array([not c or n > 0 for c, n in zip(cuts, np.diff(Words(new).first))], pa.bool_())
        columns = []
        for field in schema.fields:
            column = new if field.name == "text" else piece.column(field.name)
            if field.name == "n_chars":
                sizes = [len(t) if c else n for t, c, n in zip(texts, cuts, column.to_pylist())]
                column = pa.array(sizes, column.type)
            columns.append(column)
        return pa.RecordBatch.from_arrays(columns, schema.names).filter(keep)

    return marked.select(*schema.names, mark).mapInArrow(returning(run), schema)
