"""Language-model scores from a log-frequency Bloom filter.

Training counts all unigrams and bigrams. Each map task counts chunks of tokens and sends
packed, sorted (hash, count) arrays to the shards of the hash range; the number of shards
follows the size of the text. A shard sums its counts and writes its section of the
filter: an n-gram of count c is entered at the levels 1 .. 1 + floor(log_b c), so that a
count is read back, quantised, by probing the levels until one is missing.

The filter and the exact vocabulary (for the base score) are broadcast in segments of at
most `segment_bytes`. A worker keeps segments while they fit `resident_bytes`; beyond it,
it goes through them one after the other for each batch, so memory is bounded at any size.

P(w | u) = (c(uw) + k P(w)) / (c(u) + k),  P(w) = (c(w) + 1/2) / (N + (V + 1) / 2),
with the counts from the filter. A document starts after a mark that is not counted and
ends with the end token.

Words are known by 64-bit hashes, bigrams by 48 bits of one. Defined results: null and empty
texts are the end token alone; a null doc_id hashes as the empty text; without training
rows all counts are zero; equal rows count and come back as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import discard, stage, text_of
from .superkmers import mixed_bits

END = np.uint64(0x9AE16A3B2F90404F)
BEGIN = np.uint64(0xC2B2AE3D27D4EB4F)
#: Tokens counted or scored together in one task.
CHUNK_TOKENS = 1 << 20
#: Text behind a shard, in bytes.
SHARD_TEXT = 8 << 20
#: Bits of a bigram's name.
PAIR_BITS = 48


@dataclass(frozen=True)
class Shape:
    """base: count quantisation; probes and bits for each entry of the filter."""

    base: float = 1.5
    probes: int = 6
    bits: int = 10
    prior: float = 500.0  # k
    segment_bytes: int = 8 << 20
    resident_bytes: int = 192 << 20


def token_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the tokens of all texts, end tokens included, and the number of each text."""
    digest = xxhash.xxh3_64_intdigest
    parts, sizes = [], []
    for text in texts:
        tokens = text.encode().lower().split()
        parts += [np.fromiter(map(digest, tokens), np.uint64, len(tokens)), [END]]
        sizes.append(len(tokens) + 1)
    ids = np.concatenate(parts).astype(np.uint64) if parts else np.zeros(0, np.uint64)
    return ids, np.array(sizes, np.int64)


def pair_ids(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each token (the begin mark for the first) and the bigrams' names."""
    before = np.concatenate(([BEGIN], ids[:-1])).astype(np.uint64)
    if len(sizes):
        before[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = BEGIN
    name = mixed_bits(before * np.uint64(0x9E3779B97F4A7C15) + ids)
    return before[: len(ids)], name[: len(ids)] >> np.uint64(64 - PAIR_BITS)


def _pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted ids as differences, byte planes apart, and counts; compressed."""
    steps = np.diff(ids, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.compress(planes + counts.astype(np.uint64).view(np.uint8)
                              .reshape(-1, 8).T.tobytes(), 1)


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8)
    n = len(raw) // 16
    ids = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    counts = np.ascontiguousarray(raw[8 * n :].reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(ids, dtype=np.uint64), counts


def _chunks(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[tuple]:
    """(rows, texts) with about so many tokens; a longer text is a chunk of its own."""
    rows, texts, held = [], [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        for i, text in enumerate(batch.column("text").to_pylist()):
            rows.append([c[i] for c in columns])
            texts.append(text)
            held += len(text) // 5 + 1
            if held >= tokens:
                yield rows, texts
                rows, texts, held = [], [], 0
    if texts:
        yield rows, texts


def _levels(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(base) + 1e-9).astype(np.int64)


def level_counts(base: float, levels: int = 128) -> np.ndarray:
    """The mean whole count of each level; 0 for level 0."""
    out = [0.0]
    for q in range(1, levels):
        low = int(np.ceil(base ** (q - 1) - 1e-9))
        high = int(np.ceil(base**q - 1e-9)) - 1
        out.append((low + max(low, high)) / 2)
    return np.array(out)


def _places(ids: np.ndarray, level: np.ndarray | int, probe: int, size: np.ndarray | int):
    """Where an entry's bit is in its section."""
    seed = np.asarray(level, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    first = mixed_bits(ids + seed)
    second = mixed_bits(first ^ np.uint64(0xA0761D6478BD642F)) | np.uint64(1)
    return (first + np.uint64(probe) * second) % np.asarray(size, np.uint64)


def filter_section(ids: np.ndarray, counts: np.ndarray, shape: Shape) -> bytes:
    levels = _levels(counts, shape.base)
    size = max(64, -(-int(levels.sum()) * shape.bits // 64) * 64)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = ids[levels >= level]
        for probe in range(shape.probes):
            bits[_places(own, level, probe, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Sections:
    """Some sections of the filter, one behind the other."""

    def __init__(self, numbers: list[int], sections: list[bytes]):
        self.bits = np.frombuffer(b"".join(sections), np.uint8)
        self.numbers = np.array(numbers)
        sizes = np.array([len(s) for s in sections], np.int64)
        self.sizes, self.begins = sizes * 8, np.cumsum(sizes) - sizes

    def read(self, ids: np.ndarray, section: np.ndarray, probes: int, out: np.ndarray) -> None:
        """Sets the level of the ids in these sections. Ids are ordered by section, so
        that they are one slice of them all."""
        a, b = np.searchsorted(section, (self.numbers[0], self.numbers[-1] + 1))
        out[a:b] += self._levels(ids[a:b], section[a:b], probes)

    def _levels(self, ids: np.ndarray, section: np.ndarray, probes: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.numbers, section), len(self.numbers) - 1)
        out = np.zeros(len(ids), np.int64)
        open_ = np.flatnonzero(self.numbers[at] == section)
        level = 1
        while len(open_):
            for probe in range(probes):
                where = at[open_]
                place = _places(ids[open_], level, probe, self.sizes[where]).astype(np.int64)
                byte = self.bits[self.begins[where] + (place >> 3)]
                open_ = open_[(byte >> (place & 7).astype(np.uint8)) & 1 == 1]
            out[open_] = level
            level += 1
        return out


@dataclass
class Model:
    """What workers get: segments of the vocabulary and of the filter, and four numbers."""

    vocabulary: list[Broadcast]
    sections: list[Broadcast]
    shards: int
    tokens: int
    words: int
    documents: int
    resident: bool
    shape: Shape


def _shard(ids: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shards are equal ranges of the ids, so that sorted ids are sorted by shard."""
    return (ids >> np.uint64(bits - (shards - 1).bit_length())).astype(np.int64) if shards > 1 \
        else np.zeros(len(ids), np.int64)


def _counted(texts: DataFrame, shards: int) -> DataFrame:
    """`order`, `shard`, `packed`: counts of each chunk, cut by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in _chunks(batches, CHUNK_TOKENS):
            ids, sizes = token_ids(some)
            rows = []
            for order, names, bits in ((1, ids, 64), (2, pair_ids(ids, sizes)[1], PAIR_BITS)):
                names, counts = np.unique(names, return_counts=True)
                own = _shard(names, bits, shards)
                cuts = np.searchsorted(own, np.arange(shards + 1))
                rows += [
                    (order, s, _pack(names[a:b], counts[a:b]))
                    for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
                    if b > a
                ]
            o, s, p = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, pa.int32()), pa.array(s, pa.int32()), pa.array(p, pa.binary())],
                names=["order", "shard", "packed"],
            )

    return texts.select("text").mapInArrow(run, "order int, shard int, packed binary")


def _summed(counted: DataFrame, shards: int, shape: Shape) -> DataFrame:
    """A row for each section: its number, sums, the filter's bits, exact counts."""

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        order, shard = key
        parts = [_unpack(p) for p in rows["packed"]]
        names, place = np.unique(np.concatenate([n for n, _ in parts]), return_inverse=True)
        counts = np.zeros(len(names), np.int64)
        np.add.at(counts, place, np.concatenate([c for _, c in parts]).astype(np.int64))
        exact = names.tobytes() + counts.tobytes() if order == 1 else b""
        bits = filter_section(names, counts, shape)
        row = (int(order - 1) * shards + int(shard), len(names), int(counts.sum()),
               len(bits), len(exact), bits, exact)
        columns = ["section", "names", "tokens", "n_bits", "n_exact", "bits", "exact"]
        return pd.DataFrame([row], columns=columns)

    return counted.groupBy("order", "shard").applyInPandas(
        merge,
        "section int, names long, tokens long, n_bits long, n_exact long, "
        "bits binary, exact binary",
    )


def _segments(sections: DataFrame, column: str, most: int) -> Iterator[tuple[list, list]]:
    """Numbers and bytes of the sections, in runs of at most so many bytes together; the
    driver holds one run and one partition of the table."""
    numbers, parts, held = [], [], 0
    rows = sections.filter(f"n_{column} > 0").select("section", column).orderBy("section")
    for number, part in rows.toLocalIterator():
        if parts and held + len(part) > most:
            yield numbers, parts
            numbers, parts, held = [], [], 0
        numbers.append(number)
        parts.append(bytes(part))
        held += len(part)
    if parts:
        yield numbers, parts


def train(docs: DataFrame, shape: Shape | None = None) -> Model:
    """Counts all rows of docs."""
    shape = shape or Shape()
    context = docs.sparkSession.sparkContext
    texts = text_of(docs)
    size = texts.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("d")).first()
    shards = 1
    while shards * SHARD_TEXT < (size["n"] or 0):
        shards *= 2
    table = stage(_summed(_counted(texts, shards), shards, shape))
    unigrams = table.filter(F.col("section") < shards)
    total = unigrams.agg(F.sum("tokens").alias("n"), F.sum("names").alias("v")).first()

    def broadcast(column: str, build) -> list[Broadcast]:
        return [context.broadcast(build(*x)) for x in _segments(table, column, shape.segment_bytes)]

    def exact(_, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        names = b"".join(p[: len(p) // 2] for p in parts)
        counts = b"".join(p[len(p) // 2 :] for p in parts)
        return np.frombuffer(names, np.uint64), np.frombuffer(counts, np.int64)

    held = table.agg(F.sum(F.col("n_bits") + F.col("n_exact"))).first()[0] or 0
    vocabulary, sections = broadcast("exact", exact), broadcast("bits", Sections)
    discard(table)
    return Model(
        vocabulary,
        sections,
        shards,
        total["n"] or 0,
        total["v"] or 0,
        size["d"],
        held <= shape.resident_bytes,
        shape,
    )


def _borrowed(segments: list[Broadcast], resident: bool) -> Iterator:
    """The values of broadcast segments; beyond the resident bound only one at a time."""
    for segment in segments:
        yield segment.value
        if not resident:
            segment.__dict__.pop("_value", None)  # the worker's copy; its file remains


def _scores(model: Model, texts: list[str]) -> list[tuple]:
    """(tokens, known tokens, base score, score) of each text."""
    shape = model.shape
    ids, sizes = token_ids(texts)
    before, pairs = pair_ids(ids, sizes)
    names, at = np.unique(np.concatenate((ids, before)), return_inverse=True)
    pair_names, pair_at = np.unique(pairs, return_inverse=True)
    exact = np.zeros(len(names), np.int64)
    for own, counts in _borrowed(model.vocabulary, model.resident):
        a, b = np.searchsorted(names, own[0]), np.searchsorted(names, own[-1], "right")
        place = np.searchsorted(own, names[a:b])
        exact[a:b] += np.where(own[place] == names[a:b], counts[place], 0)
    level = np.zeros(len(names), np.int64)
    pair_level = np.zeros(len(pair_names), np.int64)
    section = _shard(names, 64, model.shards)
    pair_section = model.shards + _shard(pair_names, PAIR_BITS, model.shards)
    for sections in _borrowed(model.sections, model.resident):
        sections.read(names, section, shape.probes, level)
        sections.read(pair_names, pair_section, shape.probes, pair_level)
    table = level_counts(shape.base)
    denominator = model.tokens + 0.5 * (model.words + 1)
    word, context = at[: len(ids)], at[len(ids) :]
    single = (table[level[word]] + 0.5) / denominator
    heads = np.where(before == BEGIN, float(model.documents), table[level[context]])
    both = np.minimum(table[pair_level[pair_at]], heads)
    model_log = np.log10((both + shape.prior * single) / (heads + shape.prior))
    base_log = np.log10((exact[word] + 0.5) / denominator)
    starts = np.cumsum(sizes) - sizes
    return list(
        zip(
            sizes.tolist(),
            np.add.reduceat((exact[word] > 0).astype(np.int64), starts).tolist(),
            np.add.reduceat(base_log, starts).tolist(),
            np.add.reduceat(model_log, starts).tolist(),
            strict=True,
        )
    )


def held_out(id_col: str, parts: int, part: int):
    """Whether a row is kept from training: crc32 of its id's text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts \
        == part


def score_documents(
    docs: DataFrame, parts: int = 5, part: int = 1, shape: Shape | None = None
) -> DataFrame:
    """Trains on the rows that are not held out and scores all rows: `doc_id`, `held_out`,
    `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`."""
    rows = docs.select("doc_id", held_out("doc_id", parts, part).alias("held_out"), "text")
    model = train(rows.filter("not held_out"), shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in _chunks(batches, CHUNK_TOKENS):
            ids, flags = zip(*some, strict=True)
            n, known, base, score = zip(*_scores(model, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(flags, pa.bool_()),
                 pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                 pa.array([model.tokens] * len(ids), pa.int64()),
                 pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                       "base_score", "score"],
            )

    return rows.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
