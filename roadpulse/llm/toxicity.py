"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the mean of the vectors of its hashed character n-grams, a window of a few words
the mean of its words, and a linear softmax turns a window into the log-odds of toxic. A
document is as toxic as its worst windows (a smooth maximum), so a few words in a long text
count. Vectors and softmax are trained jointly (Adam, full batches, numpy) on a bounded
sample of labelled rows: first with each window taking its document's label, then on
documents through the maximum. Misspelt and inflected words share n-grams with known ones.

As the model is linear behind the means, workers get one number for each n-gram bucket.

The sample: at most `max_rows` documents of each label, first by a hash of the id, and of
these whole texts of at most `max_bytes` together, half of it for each label before one may
use what the other leaves; a text that does not fit is passed over, equal rows count once.
Everything else covers all rows.

Defined results: null and empty texts score the (smoothed) share of toxic labels; a null
doc_id hashes as the empty text and has no label; without rows of both labels in the
sample every score is that share; equal rows score alike; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ID, SIG, cut, id_key
from .superkmers import BYTE_HASH, mixed_bits


@dataclass(frozen=True)
class Setup:
    buckets: int = 1 << 17
    dims: int = 8
    shortest: int = 3
    longest: int = 5
    window: int = 2  # words
    sharpness: float = 4.0  # of the smooth maximum
    window_steps: int = 25
    document_steps: int = 40
    rate: float = 0.05
    decay: float = 0.1
    min_texts: int = 4
    max_rows: int = 1500  # of each label
    max_bytes: int = 48 << 20
    seed: int = 11


def _bag(words: list[bytes], setup: Setup) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of '<word>' for all words, and where each word's begin."""
    text = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    units = BYTE_HASH[text]
    gram = units.copy()
    buckets, owners = [], []
    for n in range(2, setup.longest + 1):
        gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + units[n - 1 :]
        if n >= setup.shortest:
            at = np.flatnonzero(np.arange(len(gram)) + n <= ends[: len(gram)])
            buckets.append((mixed_bits(gram[at]) % np.uint64(setup.buckets)).astype(np.int32))
            owners.append(owner[at])
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.searchsorted(owner[order], np.arange(len(words)))


def _tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words, the number of each token's word, the tokens of each text."""
    digest = xxhash.xxh3_64_intdigest
    tokens: list[bytes] = []
    sizes = []
    for text in texts:
        own = text.encode().lower().split()
        tokens += own
        sizes.append(len(own))
    ids = np.fromiter(map(digest, tokens), np.uint64, len(tokens))
    _, first, word = np.unique(ids, return_index=True, return_inverse=True)
    return [tokens[i] for i in first], word.astype(np.int32), np.array(sizes, np.int64)


def _windows(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin of each window among all tokens, and of each text among the windows. A text
    is cut evenly; texts without words have no window."""
    number = -(-sizes // width)
    text = np.repeat(np.arange(len(sizes)), number)
    begin = np.cumsum(number) - number
    place = np.arange(len(text)) - begin[text]
    offset = (np.cumsum(sizes) - sizes)[text]
    return offset + place * sizes[text] // np.maximum(number[text], 1), begin


def _means(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    sizes = np.diff(np.append(begins, len(values)))
    total = np.add.reduceat(values, begins, axis=0)
    return total / (sizes[:, None] if values.ndim > 1 else sizes)


@dataclass
class Toxicity:
    """One number for each bucket, the softmax's offset, the share of toxic labels."""

    weights: np.ndarray
    offset: float
    share: float
    setup: Setup

    def score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.share)
        words, word, sizes = _tokens(texts)
        if not words or not len(self.weights):
            return out
        bucket, begins = _bag(words, self.setup)
        each = _means(self.weights[bucket], begins)
        filled = np.flatnonzero(sizes)
        windows, texts_at = _windows(sizes[filled], self.setup.window)
        logits = _means(each[word], windows)
        out[filled] = 1 / (1 + np.exp(-(_worst(logits, texts_at, self.setup) + self.offset)))
        return out


def _worst(logits: np.ndarray, begins: np.ndarray, setup: Setup) -> np.ndarray:
    """The smooth maximum of the windows of each text."""
    top = np.maximum.reduceat(logits, begins)
    sizes = np.diff(np.append(begins, len(logits)))
    shifted = np.exp(setup.sharpness * (logits - np.repeat(top, sizes)))
    return top + np.log(np.add.reduceat(shifted, begins)) / setup.sharpness


class _Adam:
    """Adam with decoupled weight decay."""

    def __init__(self, rate: float, decay: float):
        self.rate, self.decay, self.step, self.state = rate, decay, 0, {}

    def update(self, name: str, value: np.ndarray, grad: np.ndarray) -> None:
        m, v = self.state.setdefault(name, [np.zeros_like(value), np.zeros_like(value)])
        m += 0.1 * (grad - m)
        v += 0.01 * (grad**2 - v)
        t = self.step
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        if name != "offset":
            value *= 1 - self.rate * self.decay


def _frequent(
    bucket: np.ndarray, begins: np.ndarray, word: np.ndarray, sizes: np.ndarray, setup: Setup
) -> np.ndarray:
    """The buckets with n-grams in at least `min_texts` of the texts."""
    texts_with = np.zeros(setup.buckets, np.int32)
    ends = np.append(begins[1:], len(bucket))
    for own in np.split(word, np.cumsum(sizes)[:-1]):
        own = np.unique(own)
        n = ends[own] - begins[own]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        texts_with[np.unique(bucket[np.repeat(begins[own], n) + place])] += 1
    return np.flatnonzero(texts_with >= setup.min_texts)


def train(texts: list[str], labels: np.ndarray, share: float, setup: Setup) -> Toxicity:
    """texts are not empty; both labels are there.

    A window's log-odds are means of one number for each n-gram, its vector times the
    softmax's direction; both gradients follow from that number's."""
    rng = np.random.default_rng(setup.seed)
    words, word, sizes = _tokens(texts)
    bucket, begins = _bag(words, setup)
    windows, texts_at = _windows(sizes, setup.window)
    kept = _frequent(bucket, begins, word, sizes, setup)
    grams_of = np.diff(np.append(begins, len(bucket)))
    tokens_of = np.diff(np.append(windows, len(word)))
    gram_owner = np.repeat(np.arange(len(words), dtype=np.int32), grams_of)
    token_owner = np.repeat(np.arange(len(windows), dtype=np.int32), tokens_of)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.append(texts_at, len(windows))))
    compact = np.full(setup.buckets, len(kept), np.int32)  # the last one is for all that are rare
    compact[kept] = np.arange(len(kept))
    gram = compact[bucket]
    del bucket
    vectors = rng.normal(0, 0.1, (len(kept), setup.dims))
    softmax = rng.normal(0, 0.3, (setup.dims, 2))
    offset = np.zeros(1)
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    adam = _Adam(setup.rate, setup.decay)
    for step in range(setup.window_steps + setup.document_steps):
        adam.step += 1
        direction = softmax[:, 1] - softmax[:, 0]
        each = np.append(vectors @ direction, 0.0)
        by_word = np.add.reduceat(each[gram], begins) / grams_of
        logits = np.add.reduceat(by_word[word], windows) / tokens_of
        if step < setup.window_steps:
            p = 1 / (1 + np.exp(-(logits + offset[0])))
            error = balance[text_of] * (p - labels[text_of]) / len(windows)
            d_offset = error.sum()
        else:
            worst = _worst(logits, texts_at, setup)
            p = 1 / (1 + np.exp(-np.clip(worst + offset[0], -500, 500)))
            by_text = balance * (p - labels) / len(texts)
            error = by_text[text_of] * np.exp(setup.sharpness * (logits - worst[text_of]))
            d_offset = by_text.sum()
        d_word = np.bincount(word, (error / tokens_of)[token_owner], len(words)) / grams_of
        d_each = np.bincount(gram, d_word[gram_owner], len(kept) + 1)[:-1]
        d_direction = vectors.T @ d_each
        adam.update("vectors", vectors, np.outer(d_each, direction))
        adam.update("softmax", softmax, np.stack([-d_direction, d_direction], axis=1))
        adam.update("offset", offset, np.array([d_offset]))
    weights = np.zeros(setup.buckets, np.float32)
    weights[kept] = vectors @ (softmax[:, 1] - softmax[:, 0])
    return Toxicity(weights, float(offset[0]), share, setup)


def within_budget(rows: list[tuple[int, int, int, int]], max_bytes: int) -> list[tuple[int, int, int]]:
    """Of rows (id, text hash, label, bytes) those to train on, in the order of a hash of the
    id: each label fills its share of the budget, then what is left goes to either. A text
    that does not fit is passed over and the next one tried."""
    rows = sorted(rows, key=lambda r: (xxhash.xxh64_intdigest(str(r[0])), r))
    left, taken = max_bytes, set()
    for label in (0, 1):
        share = max_bytes // 2
        for row in rows:
            if row[2] == label and row[3] <= share:
                share -= row[3]
                left -= row[3]
                taken.add(row)
    for row in rows:
        if row not in taken and row[3] <= left:
            left -= row[3]
            taken.add(row)
    return [row[:3] for row in rows if row in taken]


def fit(docs: DataFrame, labelled: DataFrame, setup: Setup) -> Toxicity:
    """docs: `_doc`, `text`; labelled: `_doc`, `label`."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    order = F.xxhash64(ID)
    chosen = cut(
        labelled.filter("label = 1").orderBy(order, ID).limit(setup.max_rows).unionByName(
            labelled.filter("label = 0").orderBy(order, ID).limit(setup.max_rows)
        )
    )  # at most 2 max_rows of two numbers
    found = docs.join(F.broadcast(chosen), ID).filter(F.octet_length("text") > 0)
    found = found.withColumn(SIG, F.xxhash64("text")).dropDuplicates([ID, SIG, "label"])
    sizes = found.select(ID, SIG, "label", F.octet_length("text").alias("n")).collect()
    picked = within_budget([tuple(r) for r in sizes], setup.max_bytes)
    wanted = docs.sparkSession.createDataFrame(picked, f"{ID} long, {SIG} long, label int")
    rows = found.join(F.broadcast(wanted), [ID, SIG, "label"]).select(ID, SIG, "label", "text").collect()
    rows.sort(key=lambda r: (r[ID], r[SIG], r["label"]))
    rows = [r for r in rows if r["text"].split()]
    labels = np.array([r["label"] for r in rows], np.float64)
    if not len(labels) or labels.min() == labels.max():
        return Toxicity(np.zeros(0), 0.0, share, setup)
    return train([r["text"] for r in rows], labels, share, setup)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 3,
    part: int = 1,
    threshold: float = 0.7,
    setup: Setup | None = None,
) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for each row of docs. Labels (`doc_id`,
    `toxic`) are learned from only where the document is not held out."""
    setup = setup or Setup()

    def out(column):
        return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts == part

    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~out(F.col("doc_id")))
    model = fit(
        docs.select(id_key(F.col("doc_id")).alias(ID), F.coalesce("text", F.lit("")).alias("text")),
        known.select(id_key(F.col("doc_id")).alias(ID), F.col("toxic").cast("int").alias("label")),
        setup,
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a in range(0, len(texts), 512):
                some = batch.slice(a, 512)
                score = shared.value.score([t or "" for t in texts[a : a + 512]])
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("held_out"), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select("doc_id", out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )
