"""Quality scores from a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics. The classes' means and covariances
come from sums over all labelled training rows (combined in the map tasks, so the driver
gets a few hundred numbers whatever the size). Covariances of the standardised statistics
are shrunk towards a multiple of the identity, factored once (Cholesky), and a score is the
logistic of the difference of the two Gaussian log-densities, divided by a temperature.

Defined results: null and empty texts have all statistics zero and get a score like any
other; a null doc_id hashes as the empty text and has no label; rows without a label are
not learned from; without rows of both labels every score is the (smoothed) share of label
1; equal rows score alike; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ID, cut, id_key, stage

STATISTICS = (
    "words", "word_length", "upper", "digits", "punctuation", "shouts", "symbols", "bars",
    "non_ascii", "distinct", "adjacent", "repeated", "bare_marks", "short", "lines",
    "line_length", "dup_lines", "byte_entropy",
)


def _class_of(members: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(members)] = 1
    return out


_CLASSES = np.stack(
    [
        _class_of(bytes(range(65, 91))),
        _class_of(b"0123456789"),
        _class_of(b".,;:?'\"()-"),
        _class_of(b"!"),
        _class_of(b"#*$%&<>@^~_=+{}[]\\/`"),
        _class_of(b"|"),
        _class_of(bytes(range(128, 256))),
    ]
)
_MARKS = b"#*$%&<>@^~_=+{}[]\\/`|.,;:!?'\"()-"


def statistics(text: bytes) -> np.ndarray:
    """The transformed statistics of a text: logarithms of sizes, square roots of shares."""
    out = np.zeros(len(STATISTICS))
    tokens = text.split()
    n = len(tokens)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = counts / len(text)
    seen = shares[shares > 0]
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = list(zip(tokens, tokens[1:], tokens[2:], strict=False))
    adjacent = sum(map(bytes.__eq__, tokens, tokens[1:]))
    out[0] = np.log1p(n)
    out[1] = np.log(sum(map(len, tokens)) / n)
    out[2:9] = np.sqrt(_CLASSES @ shares)
    out[9] = np.sqrt(len(set(tokens)) / n) * np.log1p(n) / 6
    out[10] = np.sqrt(adjacent / n)
    out[11] = np.sqrt(1 - len(set(windows)) / len(windows)) if windows else 0.0
    out[12] = np.sqrt(sum(not t.strip(_MARKS) for t in tokens) / n)
    out[13] = np.sqrt(sum(len(t) <= 3 for t in tokens) / n)
    out[14] = np.log1p(len(lines))
    out[15] = np.log1p(n / len(lines))
    out[16] = np.sqrt(1 - len(set(lines)) / len(lines))
    out[17] = float(-(seen * np.log2(seen)).sum())
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """`doc_id` and `x`, the statistics, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics((t.as_py() or "").encode()) for t in batch.column("text")]
            flat = pa.array(np.concatenate(rows) if rows else np.zeros(0), pa.float64())
            ends = pa.array(np.arange(len(rows) + 1) * len(STATISTICS), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", "x"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of the two classes."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_odds: float
    temperature: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_odds)))
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            distance = (((z - mean) @ factor.T) ** 2).sum(axis=1)
            density.append(-0.5 * (distance + log_det))
        logit = (density[1] - density[0] + self.log_odds) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def fit(labelled: DataFrame, shrinkage: float, temperature: float) -> Discriminant:
    """labelled: `label` (0 or 1) and `x`. Sums of x and of its products, by label."""
    d = len(STATISTICS)
    upper = F.expr(
        "flatten(transform(x, (a, i) -> transform(slice(x, i + 1, size(x) - i), b -> a * b)))"
    )
    sums = (
        labelled.select("label", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("x"), upper)))
        .groupBy("label", "pos")
        .agg(F.sum("col").alias("total"))
        .collect()  # two labels, one and d and d (d + 1) / 2 sums
    )
    totals = {y: np.zeros(1 + d + d * (d + 1) // 2) for y in (0, 1)}
    for row in sums:
        totals[row["label"]][row["pos"]] = row["total"]
    n = np.array([totals[0][0], totals[1][0]])
    log_odds = float(np.log((n[1] + 1) / (n[0] + 1)))
    if n.min() < 2:
        one = np.ones(d)
        return Discriminant(one * 0, one, [], [], [], log_odds, temperature)
    first = [totals[y][1 : d + 1] for y in (0, 1)]
    second = []
    for y in (0, 1):
        square = np.zeros((d, d))
        square[np.triu_indices(d)] = totals[y][d + 1 :]
        second.append(square + np.triu(square, 1).T)
    centre = (first[0] + first[1]) / n.sum()
    spread = np.diag(second[0] + second[1]) / n.sum() - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    scale[spread < 1e-12] = 1.0
    means, factors, log_dets = [], [], []
    for y in (0, 1):
        mean = first[y] / n[y]
        covariance = second[y] / n[y] - np.outer(mean, mean)
        covariance /= np.outer(scale, scale)
        shrunk = (1 - shrinkage) * covariance
        shrunk += shrinkage * max(np.trace(covariance) / d, 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(lower))
        log_dets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, means, factors, log_dets, log_odds, temperature)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 4,
    part: int = 2,
    threshold: float = 0.7,
    shrinkage: float = 0.02,
    temperature: float = 4.0,
) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for each row of docs. Labels (`doc_id`,
    `quality`) are learned from only where the document is not held out."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    rows = stage(with_statistics(docs)).withColumn("held_out", F.crc32(name) % parts == part)
    known = labels.filter("quality in (0, 1) and doc_id is not null").select(
        id_key(F.col("doc_id")).alias(ID), F.col("quality").cast("int").alias("label")
    )
    training = rows.filter("not held_out").withColumn(ID, id_key(F.col("doc_id")))
    model = fit(cut(training.join(known, ID).select("label", "x")), shrinkage, temperature)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(STATISTICS))
            score = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return rows.select("doc_id", "held_out", "x").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )
