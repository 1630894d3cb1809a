"""Windows that occur twice, found by super-k-mers: the core of both substring operators.

A window is `k` units (bytes or words) of one document. Its minimiser is the run of `m`
units with the smallest hash in it (the leftmost one on ties). Consecutive windows with
the same minimiser form a super-k-mer; equal windows have equal minimisers, so they meet
in the bucket of that key.

1. `occurrences`: the super-k-mers of all documents, without their text.
2. Only keys that occur twice go on. Super-k-mers with equal text form a class, known by
   its digest; its first occurrence (smallest document, text hash, position) stands for it, so
   that copies are combined in the map tasks and never meet as rows.
3. Only buckets with different classes need text: one packed string for each class travels
   to its bucket, where a `judge` marks the windows that occur elsewhere.
4. A bucket with more classes than `bucket_rows` is not sent to one task: its windows are
   counted by digest, with a combined aggregate.
5. `covered`: for each document the unit ranges covered by marked windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ID, SIG, discard, id_key, stage, text_of

#: Units hashed together; longer documents are cut into pieces that overlap by k - 1.
CHUNK = 1 << 20
_POSITION = np.uint64((1 << 24) - 1)
_rng = np.random.default_rng(20240229)
BYTE_HASH = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_BASES = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits (a one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_units(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The packed text, the place of each unit in it (and the end), the unit hashes."""
    raw = np.frombuffer(text, np.uint8)
    return text, np.arange(len(raw) + 1), BYTE_HASH[raw]


def word_units(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """As byte_units, for words joined by one space (each unit includes the space after)."""
    tokens = text.split()  # of bytes: ASCII white space only
    places = np.concatenate(([0], np.cumsum(np.fromiter(map(len, tokens), np.int64) + 1)))
    digest = xxhash.xxh3_64_intdigest
    return b" ".join(tokens), places, np.fromiter(map(digest, tokens), np.uint64, len(tokens))


@dataclass(frozen=True)
class Windows:
    """Windows of k units with minimisers of m units (a power of two)."""

    units: Callable[[bytes], tuple[bytes, np.ndarray, np.ndarray]]
    k: int
    m: int
    gap: int  # bytes between units in a packed string
    bucket_rows: int = 8192
    judged: int = CHUNK  # bytes of packed strings from which on a set of buckets is judged

    def runs(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and key of each super-k-mer."""
        grams, n = hashes, 1
        while n < self.m:
            grams = grams[:-n] * _BASES[n.bit_length()] + grams[n:]
            n *= 2
        grams = mixed_bits(grams)
        low = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        width, span = self.k - self.m + 1, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        place = (low & _POSITION).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        count = np.diff(np.concatenate((first, [len(place)])))
        return first, count, grams[place[first]]

    def cut(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(first window, windows, key, digest) of each super-k-mer of a text."""
        packed, places, hashes = self.units(text)
        for at in range(0, max(0, len(hashes) - self.k + 1), CHUNK):
            piece = hashes[at : at + CHUNK + self.k - 1]
            first, count, key = self.runs(piece)
            begin = places[at + first]
            end = places[at + first + count + self.k - 1] - self.gap
            digest = xxhash.xxh3_64_intdigest
            for f, c, h, a, b in zip(
                (first + at).tolist(), count.tolist(), key.view(np.int64).tolist(),
                begin.tolist(), end.tolist(), strict=True,
            ):
                yield f, c, h, digest(packed[a:b])


@dataclass
class Packed:
    """One class in its bucket: its first occurrence and its text."""

    key: int
    digest: int
    doc: int
    sig: int
    start: int
    count: int
    text: bytes


Judge = Callable[[list[Packed]], list[np.ndarray]]

_SPAN = "struct<start: int, count: int>"


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())


def occurrences(texts: DataFrame, windows: Windows) -> DataFrame:
    """`_doc`, `_sig`, `start`, `count`, `key`, `digest`: all super-k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, sigs, starts, counts, keys, digests = [], [], [], [], [], []
            for doc, sig, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for f, c, h, d in windows.cut(text.encode()):
                    docs.append(doc)
                    sigs.append(sig)
                    starts.append(f)
                    counts.append(c)
                    keys.append(h)
                    digests.append(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(sigs, pa.int64()),
                 pa.array(starts, pa.int32()), pa.array(counts, pa.int32()),
                 pa.array(keys, pa.int64()), _signed(digests)],
                names=[ID, SIG, "start", "count", "key", "digest"],
            )

    return texts.select(ID, SIG, "text").mapInArrow(
        run, f"{ID} long, {SIG} long, start int, count int, key long, digest long"
    )


def _slices(texts: DataFrame, wanted: DataFrame, windows: Windows) -> DataFrame:
    """The packed strings of the wanted super-k-mers (lists by document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, sig, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packed, places, _ = windows.units(text.encode())
                for s in spans:
                    a = places[s["start"]]
                    b = places[s["start"] + s["count"] + windows.k - 1] - windows.gap
                    rows.append(
                        (s["key"], s["digest"], doc, sig, s["start"], s["count"], packed[a:b], s["big"])
                    )
            columns = zip(*rows, strict=True) if rows else [()] * 8
            kinds = ["int64"] * 4 + ["int32"] * 2 + ["binary", "bool"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.type_for_alias(k)) for c, k in zip(columns, kinds, strict=True)],
                names=["key", "digest", "doc", "sig", "start", "count", "packed", "big"],
            )

    spans = wanted.groupBy(ID, SIG).agg(
        F.collect_list(F.struct("start", "count", "key", "digest", "big")).alias("spans")
    )
    # equal rows are one document: each class is packed once, or it would be its own copy
    once = texts.join(spans, [ID, SIG]).dropDuplicates([ID, SIG])
    return once.select(ID, SIG, "text", "spans").mapInArrow(
        run, "key long, digest long, doc long, sig long, start int, count int, packed binary, big boolean"
    )


def ranges(marked: np.ndarray) -> list[tuple[int, int]]:
    """(start, count) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _judged(packed: DataFrame, windows: Windows, judge: Judge) -> DataFrame:
    """`key`, `digest`, `spans`: the marked windows of each class, whole buckets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def verdicts(rows: list[Packed]) -> pa.RecordBatch:
            out = [
                (r.key, r.digest, [{"start": a, "count": c} for a, c in ranges(m)])
                for r, m in zip(rows, judge(rows), strict=True)
                if m.any()
            ]
            k, d, s = zip(*out, strict=True) if out else ((), (), ())
            span = pa.list_(pa.struct([("start", pa.int32()), ("count", pa.int32())]))
            return pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(d, pa.int64()), pa.array(s, span)],
                names=["key", "digest", "spans"],
            )

        rows: list[Packed] = []
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (held >= windows.judged or len(rows) >= 1 << 14) and rows[-1].key != row[0]:
                    yield verdicts(rows)
                    rows, held = [], 0
                rows.append(Packed(*row))
                held += len(row[6])
        if rows:
            yield verdicts(rows)

    return (
        packed.repartition("key")
        .sortWithinPartitions("key", "doc", "sig", "start")
        .mapInArrow(run, f"key long, digest long, spans array<{_SPAN}>")
    )


def _counted(packed: DataFrame, windows: Windows, elsewhere: Callable) -> DataFrame:
    """As _judged for buckets of any size: each window by its own digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, digest, doc, sig, start, count, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                places = windows.units(text)[1]
                for i in range(count):
                    window = text[places[i] : places[i + windows.k] - windows.gap]
                    rows.append((xxhash.xxh3_128_digest(window), key, digest, doc, sig, start + i, i))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            kinds = ["binary", "int64", "int64", "int64", "int64", "int32", "int32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.type_for_alias(k)) for c, k in zip(columns, kinds, strict=True)],
                names=["window", "key", "digest", "doc", "sig", "at", "i"],
            )

    each = packed.mapInArrow(
        run, "window binary, key long, digest long, doc long, sig long, at int, i int"
    )
    known = each.groupBy("window").agg(
        F.count("*").alias("times"), F.min(F.struct("doc", "sig", "at")).alias("earliest")
    )
    marked = each.join(known, "window").filter(elsewhere(F.col("earliest"), F.col("times")))
    one = F.struct(F.col("i").alias("start"), F.lit(1).alias("count"))
    return marked.groupBy("key", "digest").agg(F.collect_list(one).alias("spans"))


def covered(
    docs: DataFrame,
    windows: Windows,
    judge: Judge,
    whole: Callable,
    elsewhere: Callable,
) -> DataFrame:
    """`_doc`, `_sig`, `spans`: the window starts (start, count) to remove, by document.

    `judge` marks windows of a bucket's classes; `whole(first, several)` tells whether an
    occurrence (`_doc`, `_sig`, `start`) of a class (with several occurrences or one) goes as a
    whole, else the class's marks hold; `elsewhere(earliest, times)` is the judge's rule for one window of
    a class (`doc`, `sig`, `at`)."""
    texts = text_of(docs)
    # the lists of keys are tables of their own, so that Spark can split a hot key's join
    every = stage(occurrences(texts, windows))
    shared = stage(
        every.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            (F.min("digest") != F.max("digest")).alias("mixed"),
        )
        .filter("n > 1")
        .select("key", "mixed")
    )
    found = stage(every.join(shared, "key"))
    discard(every, shared)
    # equal rows are one document: what counts is whether there are different places
    place = F.xxhash64(ID, SIG, "start")
    classes = found.groupBy("key", "digest", "mixed").agg(
        (F.min(place) != F.max(place)).alias("several"),
        F.min(F.struct(ID, SIG, "start", "count")).alias("first"),
    )
    classes = stage(classes)
    crowded = (
        classes.filter("mixed")
        .groupBy("key")
        .agg(F.count("*").alias("classes"))
        .select("key", (F.col("classes") > windows.bucket_rows).alias("big"))
        .filter("big")
    )
    wanted = (
        classes.filter("mixed")
        .join(crowded, "key", "left")
        .select("key", "digest", "first.*", F.coalesce("big", F.lit(False)).alias("big"))
    )
    packed = stage(_slices(texts, wanted, windows))
    marks = _judged(packed.filter("not big").drop("big"), windows, judge).unionByName(
        _counted(packed.filter("big").drop("big"), windows, elsewhere)
    )
    rules = stage(
        classes.join(marks, ["key", "digest"], "left")
        .filter("several or spans is not null")
        .select("key", "digest", "several", "first", "spans")
    )
    discard(classes, packed)
    one = F.array(F.struct(F.lit(0).alias("start"), F.col("count").alias("count")))
    spans = F.when(whole(F.col("first"), F.col("several")), one).otherwise(F.col("spans"))
    gone = found.join(rules, ["key", "digest"]).select(
        ID, SIG, "start", F.explode(spans).alias("span")
    )
    return gone.groupBy(ID, SIG).agg(
        F.collect_list(
            F.struct(
                (F.col("start") + F.col("span.start")).alias("start"),
                F.col("span.count").alias("count"),
            )
        ).alias("spans")
    )


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """`_row` (a row of docs) and its `_spans` (null without any)."""
    keyed = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        id_key(F.col("doc_id")).alias(ID),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias(SIG),
    )
    spans = spans.withColumnRenamed("spans", "_spans")
    return keyed.join(spans, [ID, SIG], "left").select("_row", "_spans")


def unit_mask(spans: list | None, n: int, k: int) -> np.ndarray:
    """Which of n units the windows of the spans cover."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans or ():
        edge[s["start"]] += 1
        edge[s["start"] + s["count"] + k - 1] -= 1
    return np.cumsum(edge[:n]) > 0
