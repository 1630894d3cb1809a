"""Language-model scores: exact base by brute force, the filter's counts, segments."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import replace
from zlib import crc32

import numpy as np
import pytest

from roadpulse.llm.lm_filter import (
    Sections,
    Shape,
    _levels,
    _pack,
    _unpack,
    filter_section,
    level_counts,
    score_documents,
)

SF = "/root/testdata/sf0.001"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(rows):
    train = [t for d, t in rows if crc32(str("" if d is None else d).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        held = crc32(str("" if d is None else d).encode()) % 5 == 1
        out.append((d, held, len(own), sum(counts[w] > 0 for w in own), n, base))
    return out


def check(got, rows):
    got = sorted(map(tuple, got), key=str)
    want = sorted(brute(rows), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(g[6]) and g[6] <= 0


def test_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = score_documents(docs).collect()
    check(got, rows)


def test_segments_make_no_difference(spark, monkeypatch):
    """Many shards, many segments, one at a time in memory."""
    from roadpulse.llm import lm_filter

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    whole = {r.doc_id: r for r in score_documents(docs).collect()}
    monkeypatch.setattr(lm_filter, "SHARD_TEXT", 40_000)
    small = replace(Shape(), segment_bytes=30_000, resident_bytes=0)
    cut = score_documents(docs, shape=small).collect()
    for r in cut:
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score, rel=1e-12)
    # other sections, so other false positives
    total = sum(r.score for r in whole.values())
    assert sum(r.score for r in cut) == pytest.approx(total, rel=0.01)


def test_the_model_beats_single_words_where_order_matters(make_docs):
    import random

    r = random.Random(1)
    follow = {w: r.sample(range(200), 3) for w in range(200)}

    def text():
        w, out = r.randrange(200), []
        for _ in range(150):
            out.append(f"w{w}")
            w = r.choice(follow[w])
        return " ".join(out)

    got = score_documents(make_docs([(i, text()) for i in range(300)]), shape=Shape(prior=5.0))
    held = got.filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert held.s > held.b * 0.6  # both negative


def test_filter_reads_back_levels():
    r = np.random.default_rng(0)
    ids = np.unique(r.integers(0, 1 << 63, 5000, dtype=np.uint64))
    counts = r.integers(1, 500, len(ids))
    shape = Shape()
    sections = Sections([3], [filter_section(ids, counts, shape)])

    def read(ids, number):
        out = np.zeros(len(ids), np.int64)
        sections.read(ids, np.full(len(ids), number), shape.probes, out)
        return out

    got = read(ids, 3)
    true = _levels(counts, shape.base)
    assert (got >= true).all() and (got == true).mean() > 0.95
    other = r.integers(0, 1 << 63, 20000, dtype=np.uint64)
    assert (read(other, 3) > 0).mean() < 0.05
    assert (read(ids, 2) == 0).all()
    table = level_counts(shape.base)
    assert table[1] == 1 and table[2] == 2 and table[3] == 3
    exact = table[_levels(np.arange(1, 1000), shape.base)]
    assert (np.abs(exact / np.arange(1, 1000) - 1) < 0.34).all()


def test_packing():
    ids = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 1000, dtype=np.uint64))
    counts = np.arange(len(ids), dtype=np.uint64)
    again = _unpack(_pack(ids, counts))
    assert (again[0] == ids).all() and (again[1] == counts).all()


def test_edge_cases(make_docs):
    rows = [(None, "a b"), (1, None), (1, None), (2, ""), (3, "A\x0bb a"), (4, "é É " * 500)]
    docs = make_docs(rows)
    check(score_documents(docs).collect(), rows)
    assert score_documents(docs.limit(0)).count() == 0
    held = [i for i in range(50) if crc32(str(i).encode()) % 5 == 1][:2]
    lone = make_docs([(i, "x y") for i in held])  # nothing to learn from
    check(score_documents(lone).collect(), [(i, "x y") for i in held])
    clash = docs.withColumnsRenamed({"lang": "held_out", "source": "score"})
    assert score_documents(clash).count() == len(rows)
