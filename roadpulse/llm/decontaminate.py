"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is inside a document if at least `threshold` of its distinct five-word
shingles (A-Z lower-cased) are shingles of the document. Of an item with q shingles at
most q - ceil(threshold * q) can be missing, so one of its (that many plus one) smallest
shingle hashes is in every document that holds it: this MinHash sketch, whose length
depends on the item's size only, misses nothing however long the document is. Items are
partitioned by size, so that a document is searched for the sketches of items it can hold.
Candidates are verified by their exact shingles.

An item of one to four words has itself as its only shingle: it is looked for among the runs
of exactly that many words of each document, by hash and then exactly.

Items go to the workers in blocks of at most `block_bytes` of text, one scan of the
documents for each block.

Defined results: null and empty texts hold nothing and are in nothing; an item of one to
four words is inside every text with these words in a row, however long the text is;
repeated items are searched once; a null id is reported as null; each row of docs is
judged alone, equal rows alike; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .frames import union_all
from .superkmers import mixed_bits, word_units

_ROUNDING = 1e-9  # threshold * q may be just over a whole number


def least_common(q: int, threshold: float) -> int:
    return max(1, ceil(threshold * q - _ROUNDING))


def shingle_texts(text: bytes, width: int) -> list[bytes]:
    """The runs of `width` words of a lower-cased text, repeats included."""
    packed, places, _ = word_units(text)
    at = places.tolist()
    return [packed[at[i] : at[i + width] - 1] for i in range(len(at) - width)]


def shingle_hashes(units: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words, from the hashes of the words."""
    n = max(0, len(units) - width + 1)
    total = np.full(n, width, np.uint64)
    for i in range(width if n else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + units[i : i + n]
    return mixed_bits(total)


class Sketches:
    """The sketches of a block of items, partitioned by size."""

    def __init__(self, items: list[tuple[int | None, str]], size: int, threshold: float):
        self.items = []  # (id, shingles, least number in common)
        parts: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = {}
        for item, text in items:
            raw = text.encode().lower()
            units = word_units(raw)[2]
            if not len(units):
                continue
            width = min(size, len(units))
            shingles = frozenset(shingle_texts(raw, width))
            q = len(shingles)
            need = least_common(q, threshold)
            hashes = np.unique(shingle_hashes(units, width))
            own = parts.setdefault((width, q.bit_length()), [])
            own.append((hashes[: q - need + 1], len(self.items)))
            self.items.append((item, shingles, need))
        #: by width of the shingles: (least number in common, sorted hashes, their items)
        self.parts: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        for (width, _), own in parts.items():
            hashes = np.concatenate([h for h, _ in own])
            owners = np.concatenate([np.full(len(h), i) for h, i in own])
            order = np.argsort(hashes)
            need = min(self.items[i][2] for _, i in own)
            self.parts.setdefault(width, []).append((need, hashes[order], owners[order]))
        for own in self.parts.values():
            own.sort(key=lambda p: p[0])

    def find(self, text: bytes) -> list[tuple[int | None, int, int]]:
        """(item, its shingles, those in the text) of the items inside a text."""
        text = text.lower()
        units = word_units(text)[2]
        found = []
        for width, parts in self.parts.items():
            candidates = _candidates(np.unique(shingle_hashes(units, width)), parts)
            if not candidates:
                continue
            own = set(shingle_texts(text, width))
            for i in sorted(candidates):
                item, shingles, need = self.items[i]
                common = len(shingles & own)
                if common >= need:
                    found.append((item, len(shingles), common))
        return found


def _candidates(hashes: np.ndarray, parts: list[tuple[int, np.ndarray, np.ndarray]]) -> set[int]:
    """The items of which a sketched hash is among the sorted hashes of a text."""
    candidates: set[int] = set()
    for need, sketch, owners in parts:
        if need > len(hashes):
            break
        a = np.searchsorted(hashes, sketch)
        there = hashes[np.minimum(a, len(hashes) - 1)] == sketch
        candidates.update(owners[there].tolist())
    return candidates


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    block, held = [], 0
    rows = benchmark.select("item_id", "text").filter("text is not null").distinct()
    for item, text in rows.orderBy("item_id", "text").toLocalIterator():
        if block and held + len(text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += len(text)
    yield block


def _hits(sketches: Sketches, batch: pa.RecordBatch) -> list[list[tuple]]:
    return [sketches.find((t.as_py() or "").encode()) for t in batch.column("text")]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 5,
    threshold: float = 0.8,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """`doc_id`, `item_id`, `n_shingles`, `n_common`: the test items inside documents, a row
    for each item in each row of docs."""
    context = docs.sparkSession.sparkContext
    names = ["doc_id", "item_id", "n_shingles", "n_common"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]

    def search(block: list[tuple[int | None, str]]) -> DataFrame:
        shared = context.broadcast(Sketches(block, size, threshold))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                rows = [
                    (doc, *hit)
                    for doc, hits in zip(ids, _hits(shared.value, batch), strict=True)
                    for hit in hits
                ]
                columns = zip(*rows, strict=True) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )

        return docs.select("doc_id", "text").mapInArrow(
            run, "doc_id long, item_id long, n_shingles int, n_common int"
        )

    return union_all([search(block) for block in _blocks(benchmark, block_bytes)])


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 5,
    threshold: float = 0.8,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """The rows of docs that hold no test item; one pass, each block a filter behind the
    one before."""
    context = docs.sparkSession.sparkContext
    for block in _blocks(benchmark, block_bytes):
        shared = context.broadcast(Sketches(block, size, threshold))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not hits for hits in _hits(shared.value, batch)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
