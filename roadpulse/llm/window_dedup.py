"""Substring dedup of word windows by super-k-mer partitioning.

A word is removed if a window of `size` words over it also starts in a document with a
smaller doc_id; windows are judged on the input. See superkmers.py for how windows meet;
here the windows of a bucket are sorted, so that equal ones stand together and the first
one tells the smallest document.

Defined results: null and empty texts have no words; a null doc_id is the smallest; equal
rows are one document and come back as often as they came; rows that share a doc_id remove
nothing from each other; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ID
from .superkmers import Packed, Windows, covered, unit_mask, with_spans, word_units


def _judge(size: int):
    def judge(rows: list[Packed]) -> list[np.ndarray]:
        marks = [np.zeros(r.count, bool) for r in rows]
        begin = 0
        for end in range(1, len(rows) + 1):
            if end < len(rows) and rows[end].key == rows[begin].key:
                continue
            if end - begin > 1:
                _sorted_windows(rows, marks, begin, end, size)
            begin = end
        return marks

    return judge


def _sorted_windows(
    rows: list[Packed], marks: list[np.ndarray], begin: int, end: int, size: int
) -> None:
    """Sorts the windows of one bucket, whose classes are ordered by document."""
    entries = []
    for i in range(begin, end):
        text = rows[i].text
        places = word_units(text)[1].tolist()
        entries += [(text[places[j] : places[j + size] - 1], i, j) for j in range(rows[i].count)]
    entries.sort()
    window, first = None, 0
    for text, i, j in entries:
        if text != window:
            window, first = text, rows[i].doc
        elif first < rows[i].doc:
            marks[i][j] = True


def window_report(docs: DataFrame, size: int = 50, windows: Windows | None = None) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_sha256`, `kept_text` for each row of docs."""
    windows = windows or Windows(word_units, size, 4 if size >= 8 else 1, 1)
    spans = covered(
        docs,
        windows,
        _judge(size),
        whole=lambda head, several: F.col(ID) > head[ID],
        elsewhere=lambda earliest, times: earliest["doc"] < F.col("doc"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts, spans = batch.column("text").to_pylist(), batch.column("_spans").to_pylist()
            for text, own in zip(texts, spans, strict=True):
                tokens = (text or "").encode().split()
                n = len(tokens)
                if own:
                    gone = unit_mask(own, n, size)
                    tokens = [tokens[i] for i in np.flatnonzero(~gone)]
                kept = b" ".join(tokens)
                out.append(
                    (n, n - len(tokens), hashlib.sha256(kept).hexdigest(), kept.decode())
                )
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    frame = with_spans(docs.select("doc_id", "text"), spans)
    return frame.select("_row.doc_id", "_row.text", "_spans").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
