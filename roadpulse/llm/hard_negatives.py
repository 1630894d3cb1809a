"""Hard negatives by segment summaries.

Each vector keeps, for its segments at several depths, their mean and deviation (the norm
of what the mean leaves). Two segments' product lies within length * mean * mean, plus or
minus deviation * deviation; the sums over the segments bound the score of two vectors.
Coarse summaries are tried first; only pairs that still can matter are refined, and those
that survive the finest depth are scored exactly.

Anchors go to the workers in blocks. For each block the rows are passed twice, each task
keeping the best rows it has seen: first for the anchors' positives, then for the negatives
whose score lies within a share of a positive's. What the tasks keep meets per anchor.

Scores are integer inner products, told exactly: components are floor(scale * x), and beyond
+-2^22 they are cut to that (a score then stays below 2^53 for up to 512 components).

Defined results: rows with a null label, a null vector or a null or non-finite component
take no part; equal rows are one row, rows that differ under one id are rows of their own; a
null id is never an anchor, may be found, and is the smallest on ties; vectors of different
lengths are compared as if the shorter ended in zeros; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import discard, id_key, stage, union_all

#: Segments of a vector at each depth, coarse to fine.
DEPTHS = (1, 4, 16)
_CELLS = 1 << 21  # pairs of a row and an anchor that are bounded at once
_NULL = -(2**63)  # stands for a null id, as in id_key
_LIMIT = 1 << 22


def summaries(vectors: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per depth the length of a segment, the means and the deviations of all segments.

    The number of columns is a multiple of the finest depth."""
    out = []
    for n in DEPTHS:
        parts = vectors.reshape(len(vectors), n, -1)
        means = parts.mean(2)
        out.append((parts.shape[2], means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(2))))
    return out


def padded(lists: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, own in enumerate(lists):
        out[i, : len(own)] = own
    return out


def usable(embeddings: DataFrame, label: Column, scale: float) -> DataFrame:
    """`id`, `label`, `vector` (integers) of the rows that take part, each once."""
    sound = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(
        "embedding",
        lambda x: F.floor(
            F.greatest(F.least(x.cast("double") * scale, F.lit(float(_LIMIT))), F.lit(-float(_LIMIT)))
        ).cast("int"),
    )
    return (
        embeddings.filter(label.isNotNull() & F.col("embedding").isNotNull())
        .filter(sound)
        .select(id_key(F.col("vec_id")).alias("id"), label.cast("long").alias("label"), whole.alias("vector"))
        .distinct()
    )


def _summarised(rows: DataFrame, width: int) -> DataFrame:
    """The rows with the summaries of all depths, in one list of means and one of deviations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depths = summaries(padded(batch.column("vector").to_pylist(), width))
            lists = []
            for part in (1, 2):
                flat = np.concatenate([d[part] for d in depths], 1)
                ends = pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32())
                lists.append(pa.ListArray.from_arrays(ends, pa.array(flat.ravel())))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *lists], names=["id", "label", "vector", "means", "deviations"]
            )

    return rows.mapInArrow(
        run,
        "id long, label long, vector array<int>, means array<double>, deviations array<double>",
    )


class Anchors:
    """A block of anchors with what is known of their wanted score ranges.

    `least` and `most` (anchors by slots) are the scores that still matter for each slot; a
    slot keeps its `k` best rows, the highest score first, the smaller id on ties."""

    def __init__(self, ids, labels, vectors, k, same, least, most):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.k, self.same = k, same
        self.least, self.most = least, most

    def scan(self, batches: Iterator[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id) of the best rows, from batches of (ids, labels, vectors,
        summaries)."""
        depths = summaries(self.vectors)
        least = self.least.copy()
        slots = least.shape[1]
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        for ids, labels, vectors, own in batches:
            alive = (labels[:, None] == self.labels) == self.same
            itself = alive & (ids[:, None] == self.ids) & (labels[:, None] == self.labels)
            for r, a in zip(*np.nonzero(itself), strict=True):
                alive[r, a] = not np.array_equal(vectors[r], self.vectors[a])
            low, high = least.min(1), self.most.max(1)
            for (length, mean, spread), (_, means, spreads) in zip(depths, own, strict=True):
                r, a = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
                if not len(r):
                    break
                centre = (means[r] * length) @ mean[a].T
                radius = spreads[r] @ spread[a].T
                # rounding can only widen the bounds
                sizes = np.abs(means[r] * length) @ np.abs(mean[a]).T
                radius += 1e-9 * (radius + sizes) + 1e-6
                alive[np.ix_(r, a)] &= (centre + radius >= low[a]) & (centre - radius <= high[a])
            r, a = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
            if not len(r):
                continue
            scores = vectors[r] @ self.vectors[a].T  # whole numbers below 2^53
            left = alive[np.ix_(r, a)]
            new = [held]
            for s in range(slots):
                x, y = np.nonzero(left & (scores >= least[a, s]) & (scores <= self.most[a, s]))
                new.append((a[y] * slots + s, scores[x, y].astype(np.int64), ids[r[x]]))
            held = self._best(*(np.concatenate(c) for c in zip(*new, strict=True)))
            full = np.bincount(held[0], minlength=least.size) == self.k
            last = np.flatnonzero(np.append(held[0][1:] != held[0][:-1], True)) if len(held[0]) else []
            for i in last:
                if full[held[0][i]]:
                    least.flat[held[0][i]] = max(least.flat[held[0][i]], held[1][i])
        return held

    def _best(self, slot, score, ids):
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))[: len(slot)]
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        return slot[keep], score[keep], ids[keep]


def _batches(batches: Iterator[pa.RecordBatch], n_anchors: int, width: int) -> Iterator[tuple]:
    size = max(1, _CELLS // max(1, n_anchors))
    ends = np.cumsum((0, *DEPTHS))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            flat = [
                part.column(c).flatten().to_numpy().reshape(part.num_rows, -1)
                for c in ("means", "deviations")
            ]
            yield (
                part.column("id").to_numpy(),
                part.column("label").to_numpy(),
                padded(part.column("vector").to_pylist(), width),
                [(0, *(f[:, a:b] for f in flat)) for a, b in zip(ends[:-1], ends[1:], strict=True)],
            )


def _best_rows(rows: DataFrame, anchors: Anchors) -> DataFrame:
    """`slot`, `place`, `score`, `id`: the best rows of each slot, over all tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        found = own.scan(_batches(batches, len(own.ids), own.vectors.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in found], names=["slot", "score", "id"]
        )

    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    # a table of its own: at most k rows of a slot from each partition meet
    kept = stage(rows.mapInArrow(run, "slot long, score long, id long"))
    return kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= anchors.k)


def hard_negatives(
    embeddings: DataFrame,
    label: Column | None = None,
    is_anchor: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 5,
    least_percent: int = 80,
    scale: float = 256.0,
    block_anchors: int = 4096,
) -> DataFrame:
    """`anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    `is_anchor` is over `id`. An anchor's positives are its best rows of the same label; a
    positive's negatives the best rows of other labels that score at least `least_percent` of
    it, and no more than it."""
    spark = embeddings.sparkSession
    label = F.col("label") if label is None else label
    rows = stage(usable(embeddings, label, scale))
    longest = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    width = max(1, -(-longest // DEPTHS[-1])) * DEPTHS[-1]
    table = stage(_summarised(rows, width))
    discard(rows)
    chosen = table.filter(F.col("id") != _NULL)
    if is_anchor is not None:
        chosen = chosen.filter(is_anchor)
    chosen = chosen.select("id", "label", "vector").orderBy("id", "label", "vector")
    found, block = [], []
    for row in (*chosen.toLocalIterator(), None):
        if row is not None:
            block.append(row)
        if block and (row is None or len(block) == block_anchors):
            found.append(
                _mined(table, block, width, n_positives, n_negatives, least_percent)
            )
            block = []
    if not found:
        return spark.createDataFrame(
            [],
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
            "negative_score long",
        )
    return union_all(found)


def _mined(table, block, width, n_positives, n_negatives, least_percent) -> DataFrame:
    spark = table.sparkSession
    ids = np.array([r.id for r in block], np.int64)
    labels = np.array([r.label for r in block], np.int64)
    vectors = padded([r.vector for r in block], width)
    anything = np.full((len(ids), 1), np.inf)
    near = Anchors(ids, labels, vectors, n_positives, True, -anything, anything)
    positives = _best_rows(table, near).collect()  # n_positives for each anchor of the block
    least = np.full((len(ids), n_positives), np.inf)
    most = np.full((len(ids), n_positives), -np.inf)
    pairs = []
    for slot, score, positive, place in positives:
        if score >= 0:  # a negative score is above its own share
            least[slot, place - 1] = -(-least_percent * score // 100)
            most[slot, place - 1] = score
        pairs.append((slot * n_positives + place - 1, int(ids[slot]), positive, score))
    hard = Anchors(ids, labels, vectors, n_negatives, False, least, most)
    # bounded by the block; joined without a shuffle of its own if Spark finds it small
    known = spark.createDataFrame(
        pairs, "slot long, anchor_id long, positive_id long, positive_score long"
    )
    back = {c: F.when(F.col(c) != _NULL, F.col(c)).alias(c) for c in ("positive_id", "negative_id")}
    return (
        _best_rows(table, hard)
        .withColumnsRenamed({"id": "negative_id", "score": "negative_score", "place": "rank"})
        .join(known, "slot")
        .select(
            "anchor_id", back["positive_id"], "rank", back["negative_id"], "positive_score",
            "negative_score",
        )
    )
