"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan
distance of two such vectors never exceeds the Hamming distance of the fingerprints, so
fingerprints within `max_bits` have vectors within `max_bits`. The vector is cut into
blocks of segments; at least `blocks - max_bits` blocks then agree in full, so that
linked fingerprints share a grid cell for at least one choice of that many blocks. A cell
is range-joined on the total bit count; pairs whose vectors are within `max_bits` by
Manhattan distance are verified by Hamming distance. No link is lost
and no cell is capped: cells with many members are dealt out as pairs of tiles.

Only different fingerprints are compared, and each tile sends a spanning forest of its
links, never all pairs.

Defined results: null and empty texts have fingerprint zero, linked like any other; a
null doc_id counts as the smallest id (its group has a null component_id); equal rows
come back as often as they came; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import ID, SIG, cut, id_key

SEGMENTS = 32
#: Two random segments have the same count with this probability: 1/16 + 1/4 + 1/16.
AGREE = 3 / 8
LOW_BITS = 0x5555555555555555


def fingerprint(text: bytes, shingle: int) -> int:
    """The 64-bit fingerprint of UTF-8 bytes."""
    tokens = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    if len(tokens) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(tokens), 42)]
    else:
        joined = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate(([0], ends[: -shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [
            digest(joined[a:b], 42)
            for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)
        ]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """`fp` (the fingerprint as a signed long) of each `text`, beside the other columns
    (longs) of docs."""
    keys = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [
                fingerprint((x.as_py() or "").encode(), shingle) for x in batch.column("text")
            ]
            fp = np.array(marks, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), pa.array(fp, pa.int64())], names=[*keys, "fp"]
            )

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in [*keys, "fp"]))


def blocks_for(n: int, max_bits: int, partners: int = 20_000) -> int:
    """The fewest blocks for which a random fingerprint among n is expected to meet at
    most `partners` others. Any number of blocks over max_bits finds all links; more make
    finer cells for more copies of each fingerprint."""
    for blocks in range(max_bits + 2, SEGMENTS + 1):
        agreeing = blocks - max_bits
        chance = AGREE ** (SEGMENTS * agreeing / blocks)
        if comb(blocks, agreeing) * n * chance <= partners:
            return blocks
    return SEGMENTS


def _cell_masks(blocks: int, max_bits: int) -> list[int]:
    """For each choice of blocks, the bits of the packed counts that name a cell."""
    bounds = [SEGMENTS * i // blocks for i in range(blocks + 1)]
    block_masks = [
        ((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(bounds, bounds[1:], strict=False)
    ]
    masks = [sum(c) for c in combinations(block_masks, blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def unary_counts(marks: np.ndarray) -> np.ndarray:
    """The bit counts of the segments as 00, 01 and 11, so that the Manhattan distance of
    two vectors is the number of bits that differ."""
    low, half = np.uint64(LOW_BITS), marks >> np.uint64(1)
    return ((marks & half & low) << np.uint64(1)) | ((marks | half) & low)


def spanning_links(marks: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within max_bits among different fingerprints.

    Rows are ordered by their total bit count; a mark meets only the marks not yet
    reached whose count differs by max_bits at most; those with vectors within max_bits are
    verified exactly."""
    counts = np.bitwise_count(marks)
    order = np.argsort(counts, kind="stable")
    marks, counts = marks[order], counts[order].astype(np.int64)
    vectors = unary_counts(marks)
    left = np.arange(len(marks))  # not yet reached, ordered by count
    links = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            a, b = np.searchsorted(
                counts[left], (counts[at] - max_bits, counts[at] + max_bits + 1)
            )
            apart = np.bitwise_count(vectors[left[a:b]] ^ vectors[at])
            near = np.flatnonzero(apart <= max_bits) + a
            near = near[np.bitwise_count(marks[left[near]] ^ marks[at]) <= max_bits]
            if len(near):
                links += [(at, x) for x in left[near]]
                queue += left[near].tolist()
                left = np.delete(left, near)
    return [(int(marks[a].view(np.int64)), int(marks[b].view(np.int64))) for a, b in links]


def fingerprint_links(
    distinct: DataFrame, max_bits: int, blocks: int, tile: int = 4096
) -> DataFrame:
    """Links (`u`, `v`) that connect what is within max_bits among different `fp`."""
    half = F.shiftrightunsigned("fp", 1)
    counts = F.shiftleft(
        F.col("fp").bitwiseAND(half).bitwiseAND(F.lit(LOW_BITS)), 1
    ).bitwiseOR(F.col("fp").bitwiseXOR(half).bitwiseAND(F.lit(LOW_BITS)))
    masks = _cell_masks(blocks, max_bits)
    cells = distinct.select("fp", counts.alias("counts")).select(
        "fp", F.posexplode(F.array(*[F.col("counts").bitwiseAND(F.lit(m)) for m in masks]))
    ).withColumnsRenamed({"pos": "choice", "col": "cell"})
    large = (
        cells.groupBy("choice", "cell")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > tile)
        .select("choice", "cell", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = (
        cells.join(large, ["choice", "cell"], "left")
        .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            F.xxhash64(
                "choice", "cell", F.least("own", "other"), F.greatest("own", "other")
            ).alias("group"),
            "fp",
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(groups, marks):
            cuts = np.flatnonzero(np.diff(groups)) + 1
            found = []
            for a, b in zip(
                np.concatenate(([0], cuts)), np.concatenate((cuts, [len(groups)])), strict=True
            ):
                if b - a > 1:
                    found += spanning_links(np.unique(marks[a:b]).view(np.uint64), max_bits)
            u, v = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
            )

        for batch in batches:  # the last group of a batch may go on in the next one
            group = np.concatenate((group, batch.column(0).to_numpy()))
            rest = np.concatenate((rest, batch.column(1).to_numpy()))
            if len(group) and group[0] != group[-1]:
                at = int(np.searchsorted(group, group[-1]))
                yield links(group[:at], rest[:at])
                group, rest = group[at:], rest[at:]
        if len(group):
            yield links(group, rest)

    return (
        dealt.repartition("group").sortWithinPartitions("group").mapInArrow(run, "u long, v long")
    )


def _owned(marked: DataFrame, first: Column, max_bits: int, blocks: int | None) -> DataFrame:
    """`fp`, `first` (an aggregate of its rows), `root` for each different fingerprint; root
    names the group."""
    distinct = cut(marked.groupBy("fp").agg(first.alias("first")))
    if blocks is None:
        blocks = blocks_for(distinct.count(), max_bits)
    roots = cut(components(fingerprint_links(distinct, max_bits, blocks)))
    return cut(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        )
    )


def simhash_groups(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int | None = None
) -> DataFrame:
    """`doc_id`, `fingerprint` (hexadecimal), `component_id` for each row of docs."""
    marked = cut(fingerprints(docs.select(id_key(F.col("doc_id")).alias(ID), "text"), shingle))
    owned = _owned(marked, F.min(ID), max_bits, blocks)
    least = owned.groupBy("root").agg(F.min("first").alias("component"))
    of_mark = owned.join(least, "root").select("fp", "component")
    null_id = F.lit(-(2**63))
    return marked.join(of_mark, "fp").select(
        F.nullif(ID, null_id).alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.nullif("component", null_id).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of docs for each group: its smallest document by id, then by a hash of the
    text. Different texts under one id, or without an id, are documents of their own."""
    key = [id_key(F.col("doc_id")).alias(ID), F.xxhash64(F.coalesce("text", F.lit(""))).alias(SIG)]
    marked = fingerprints(docs.select(*key, "text"), shingle)
    owned = _owned(marked, F.min(F.struct(ID, SIG)), max_bits, None)
    kept = owned.groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *key)
    return rows.join(kept, [ID, SIG], "left_semi").dropDuplicates([ID, SIG]).select("_row.*")
