"""Ranked lexical search for a set of test items, by hashed max-sketches.

Each document's impacts (the score that a term adds) fold into a sketch of `width`
coordinates, each the largest impact of the terms hashed to it. The sum of an item's
coordinates is an upper bound of the document's score, for all items of a block at once.
Documents are rescored exactly in descending order of the bound, until it falls below the
`k`-th best score so far; no document that belongs to the result is skipped.

1. One scan of the texts counts the items' terms in each document; only these counts, with
   the document's length, are written.
2. Corpus figures (documents, terms, documents per term) are aggregates over all of them.
3. Each task keeps the best `k` of its documents per item; these meet per item, at most `k`
   from each partition.

The items go to the workers in blocks: `vocabulary_bytes` of item text for a scan of the
texts, `block_bytes` for a pass over the counts.

Defined results: a term is a maximal run of ASCII letters and digits and non-ASCII
characters, A-Z lower-cased; null and empty texts have none, are in no count and are never
found; each row of docs is a document, equal rows too, and a null id comes first on equal
scores; equal items are one, items that differ under one id are each ranked; an item without
terms finds nothing; extra columns do not matter; texts of any length are counted whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .decontaminate import _blocks
from .frames import discard, stage, union_all

#: Bytes that part terms become spaces, A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: Documents that are bounded, and rescored, at once.
_BATCH, _CHUNK = 2048, 64


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def _counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """`doc_id`, `n`, and the numbers and occurrences of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            sizes, ids, times, ends = [], [], [], [0]
            for text in batch.column("text"):
                tokens = terms(text.as_py() or "")
                found = Counter(map(number, tokens))
                found.pop(None, None)
                sizes.append(len(tokens))
                own = sorted(found)
                ids += own
                times += map(found.__getitem__, own)
                ends.append(len(ids))
            cut = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cut, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(cut, pa.array(times, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, times array<int>"
    )


class Block:
    """A block of items, ready to bound and to rescore documents.

    `items` are (item_id, numbers of its terms); `weights` and `length` (terms of all
    documents over their number, as a pair) come from the corpus."""

    def __init__(self, items, vocabulary, weights, n_docs, n_terms, k, width):
        self.items = items
        self.weights = weights  # by term number, 0 for terms of other blocks
        self.n_docs, self.n_terms = n_docs, n_terms
        self.k, self.width = k, width
        self.coordinate = np.fromiter(
            (xxhash.xxh3_64_intdigest(t) % width for t in vocabulary), np.int64, len(vocabulary)
        )
        self.lookups = np.zeros((width, len(items)))
        for q, (_, numbers) in enumerate(items):
            np.add.at(self.lookups[:, q], self.coordinate[numbers], 1)

    def search(self, docs: Iterator[tuple]) -> list[tuple[int, int, int | None]]:
        """(item, score, doc_id): the best k documents of each item, from batches of
        (ids, lengths, ends, terms, times)."""
        best: list[list[tuple[int, int | None]]] = [[] for _ in self.items]
        least = np.ones(len(self.items), np.int64)  # scores above 0 only
        for ids, lengths, ends, numbers, times in docs:
            doc = np.repeat(np.arange(len(ids)), np.diff(ends))
            norms = np.array(
                [50 + 50 * int(n) * self.n_docs // self.n_terms for n in lengths], np.int64
            )
            impacts = self.weights[numbers] * (
                1_000_000_000 * times // (1000 * times + 20 * norms[doc])
            )
            sketch = np.zeros((len(ids), self.width))
            np.maximum.at(sketch, (doc, self.coordinate[numbers]), impacts.astype(float))
            bounds = sketch @ self.lookups
            # terms ascend within a document, so the keys are sorted
            keys = doc * len(self.weights) + numbers
            for q in np.flatnonzero((bounds >= least).any(0)):
                self._rescore(q, bounds[:, q], ids, keys, impacts, best, least)
        return [(q, s, d) for q, own in enumerate(best) for s, d in own]

    def _rescore(self, q, bound, ids, keys, impacts, best, least) -> None:
        numbers = self.items[q][1]
        open_ = np.flatnonzero(bound >= least[q])
        open_ = open_[np.argsort(-bound[open_], kind="stable")]
        for at in range(0, len(open_), _CHUNK):
            chunk = open_[at : at + _CHUNK]
            if bound[chunk[0]] < least[q]:
                break
            wanted = chunk[:, None] * len(self.weights) + numbers
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            scores = np.where(keys[place] == wanted, impacts[place], 0).sum(1)
            good = scores >= least[q]
            if good.any():
                own = best[q] + [
                    (int(s), ids[d])
                    for s, d in zip(scores[good], chunk[good], strict=True)
                ]
                own.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
                best[q] = own[: self.k]
                if len(best[q]) == self.k:
                    least[q] = best[q][-1][0]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            numbers, times = part.column("terms"), part.column("times")
            offsets = numbers.offsets.to_numpy()
            if offsets[-1] > offsets[0]:
                yield (
                    part.column("doc_id").to_pylist(),
                    part.column("n").to_numpy(),
                    offsets - offsets[0],
                    numbers.flatten().to_numpy().astype(np.int64),
                    times.flatten().to_numpy().astype(np.int64),
                )


def _best(counts: DataFrame, block: Block) -> DataFrame:
    """`item`, `item_id`, `score`, `doc_id`: the best documents of each task."""
    shared = counts.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        found = own.search(_batches(batches))
        columns = [
            [q for q, _, _ in found], [own.items[q][0] for q, _, _ in found],
            [s for _, s, _ in found], [d for _, _, d in found],
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns],
            names=["item", "item_id", "score", "doc_id"],
        )

    return counts.mapInArrow(run, "item long, item_id long, score long, doc_id long")


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    width: int = 1024,
    block_bytes: int = 256 << 10,
    vocabulary_bytes: int = 16 << 20,
) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: for each item the `k` documents with the highest
    scores above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    found = []
    for group in _blocks(items, vocabulary_bytes):
        parsed = [(item, sorted(set(terms(text)))) for item, text in group]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, own in parsed for t in own}))}
        counts = stage(_counts(docs, vocabulary))
        whole = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_docs, n_terms = whole
        # at most a row for each term of the group's items
        df = np.zeros(len(vocabulary), np.int64)
        for number, n in (
            counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator()
        ):
            df[number] = n
        weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
        block, held = [], 0
        blocks = [block]
        for (item, own), (_, text) in zip(parsed, group, strict=True):
            if block and held + len(text) > block_bytes:
                block, held = [], 0
                blocks.append(block)
            block.append((item, np.array([vocabulary[t] for t in own], np.int64)))
            held += len(text)
        for number, block in enumerate(blocks):
            used = np.zeros(len(vocabulary), bool)
            for _, numbers in block:
                used[numbers] = True
            ready = Block(
                block, vocabulary, np.where(used, weights, 0), n_docs, max(1, n_terms), k, width
            )
            # a table of its own, so that a lost executor repeats no search
            found.append(stage(_best(counts, ready)).withColumn("block", F.lit(len(found))))
        discard(counts)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("block", "item").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_first()
    )
    return (
        union_all(found)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
