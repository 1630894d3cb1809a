"""Quality and toxicity on held-out labels, and edge cases."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
import xxhash

from roadpulse.llm.quality_model import STATISTICS, Discriminant, fit, score_quality, statistics
from roadpulse.llm.toxicity import Setup, _bag, _windows, score_toxicity, train, within_budget

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def held_out(spark, scored, column):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scored.filter("held_out").join(labels, "doc_id").select("score", "predicted", column)
    return tuple(np.array(x) for x in zip(*rows.collect(), strict=True))



def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    for run, column, parts, part in (
        (score_quality, "quality", 4, 2), (score_toxicity, "toxic", 3, 1)
    ):
        scored = run(docs, labels).cache()
        assert scored.count() == docs.count()
        for r in scored.collect():
            assert r.held_out == (crc32(str(r.doc_id).encode()) % parts == part)
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        score, _, label = held_out(spark, scored, column)
        assert auc(score, label) > 0.95


def test_held_out_labels_are_not_learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr(
        "doc_id",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) quality",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - toxic, toxic) toxic",
    )
    for run in (score_quality, score_toxicity):
        a, b = (
            {r.doc_id: r.score for r in run(docs.limit(300), x).collect()} for x in (labels, flipped)
        )
        assert a == pytest.approx(b, abs=1e-9)


def test_discriminant_against_the_densities(spark):
    r = np.random.default_rng(0)
    d = len(STATISTICS)
    x = [r.normal(0, 1, (400, d)), r.normal(0.4, 1.5, (300, d))]
    rows = [(y, [float(v) for v in row]) for y in (0, 1) for row in x[y]]
    model = fit(spark.createDataFrame(rows, "label int, x array<double>"), 0.2, 1.0)
    points = r.normal(0, 2, (20, d))
    pooled = np.concatenate(x)
    centre, scale = pooled.mean(0), pooled.std(0)
    density = []
    for own in x:
        z = (own - centre) / scale
        c = np.cov(z.T, bias=True)
        c = 0.8 * c + 0.2 * np.trace(c) / d * np.eye(d)
        delta = (points - centre) / scale - z.mean(0)
        density.append(-0.5 * (np.einsum("ij,jk,ik->i", delta, np.linalg.inv(c), delta)
                               + np.linalg.slogdet(c)[1]))
    logit = density[1] - density[0] + np.log(301 / 401)
    assert model.score(points) == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def test_statistics():
    assert not statistics(b"").any() and not statistics(b" \n ").any()
    x = dict(zip(STATISTICS, statistics("Ab é! | ab ab\nab".encode()), strict=True))
    assert x["words"] == pytest.approx(np.log1p(6))
    assert x["bars"] == pytest.approx(np.sqrt(1 / 17)) and x["lines"] == pytest.approx(np.log(3))


def test_bags_and_windows():
    setup = Setup(buckets=1 << 40)
    bucket, begins = _bag([b"abc", b"a", b"xabc"], setup)
    grams = [set(x.tolist()) for x in np.split(bucket, begins[1:])]
    # <abc>: 3 + 2 + 1; <a>: 1; <xabc>: 4 + 3 + 2
    assert [len(x) for x in np.split(bucket, begins[1:])] == [6, 1, 9]
    assert len(grams[0] & grams[2]) == 3  # abc, bc>, abc>
    windows, texts = _windows(np.array([1, 8, 20]), 8)
    assert windows.tolist() == [0, 1, 9, 15, 22] and texts.tolist() == [0, 1, 2]


def test_misspellings_share_grams(prose):
    texts, labels = [], []
    for i in range(160):
        words = prose(i, 60).split()
        if i % 2:
            words[i % 50] = ["nastyword", "nastywords", "nastyworded"][i % 3]
        texts.append(" ".join(words))
        labels.append(i % 2)
    setup = Setup(buckets=1 << 14)
    model = train(texts, np.array(labels, float), 0.5, setup)
    clean = [prose(900 + i, 60) for i in range(40)]
    toxic = [f"{t} nastyw0rd {prose(i, 10)}" for i, t in enumerate(clean)]
    assert np.median(model.score(toxic)) > 0.7 > 0.5 > np.median(model.score(clean))


def test_edge_cases(make_docs, spark):
    docs = make_docs([(None, "a b"), (1, None), (2, ""), (3, "x " * 3000), (3, "x " * 3000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame(
        [(None, 1, 1), (1, None, None), (2, 1, 0), (2, 1, 0), (3, 0, 1), (9, 1, 1)], none.schema
    )
    for run in (score_quality, score_toxicity):
        for labels in (none, some):
            got = run(docs, labels).collect()
            assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
            assert len({r.score for r in got if r.doc_id == 3}) == 1
        assert {r.score for r in run(docs, none).collect()} == {0.5}
        assert run(docs.limit(0), some).count() == 0
        clash = docs.withColumnsRenamed({"lang": "quality", "source": "label", "n_chars": "toxic"})
        assert run(clash, some).count() == 5
    assert isinstance(fit(spark.createDataFrame([], "label int, x array<double>"), 0.1, 1.0), Discriminant)


def test_texts_over_the_budget_are_passed_over(make_docs, spark, prose):
    """One of the first labelled texts is over the budget on its own; then all of them are."""
    ids = sorted(
        (i for i in range(400) if crc32(str(i).encode()) % 3 != 1),
        key=lambda i: xxhash.xxh64_intdigest(str(i)),
    )
    texts = {i: prose(i, 60) + (" nastyword nastyword" if n % 2 else "") for n, i in enumerate(ids)}
    setup = Setup(buckets=1 << 14, max_bytes=1 << 17)
    texts[ids[1]] = prose(1, 60) + " " + "long " * 30_000
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    new = [(1000 + i, prose(1000 + i, 60) + " nastyword nastyword" * (i % 2)) for i in range(20)]
    docs = make_docs([*texts.items(), *new])
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, labels, setup=setup).collect()}
    assert [got[i] for i, _ in new] == [i % 2 for i in range(20)]
    none = score_toxicity(docs, labels, setup=Setup(buckets=1 << 14, max_bytes=100))
    assert none.select("score").distinct().count() == 1


def test_budget_of_the_sample():
    small = [(i, 0, i % 2, 10) for i in range(10)]
    assert sorted(r[0] for r in within_budget(small, 100)) == list(range(10))
    long = [(i, 0, 0, 1000) for i in range(10, 30)]
    assert sorted(r[0] for r in within_budget([*small, *long], 100)) == list(range(10))
    heavy = [(i, 0, 0, 40) for i in range(30, 90)]
    some = within_budget([*heavy, *((i, 0, 1, 10) for i in range(10))], 200)
    assert sum(r[2] for r in some) == 10 and sum(1 - r[2] for r in some) == 2
    assert within_budget(long, 100) == []
    uneven = [(0, 0, 1, 10), *((i, 0, 0, 30) for i in range(1, 4))]
    assert len(within_budget(uneven, 100)) == 4


def test_the_sample_is_not_cut():
    assert (Setup().max_rows, Setup().max_bytes) == (1500, 48 << 20)
