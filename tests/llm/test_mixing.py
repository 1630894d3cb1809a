"""The mix: exponent, quotas, permutations."""

from __future__ import annotations

from collections import Counter
from math import log

import pytest

from pyspark.sql import functions as F

from roadpulse.llm import mixing
from roadpulse.llm.mixing import Target, fit_exponent, schedule


@pytest.fixture(scope="module")
def docs(make_docs):
    rows = []
    for source, n, length in (("big", 400, 20), ("mid", 90, 25), ("small", 30, 10)):
        rows += [(len(rows) + i, "w " * length, "en", source, 0) for i in range(n)]
    return make_docs(rows)


def tokens(rows):
    out = Counter()
    for r in rows:
        out[r.source] += r.n_tokens
    return out


def test_repetition_limit_without_a_budget(docs):
    rows = schedule(docs, Target(max_repeats=3.0), block_docs=16).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    times = Counter(r.doc_id for r in rows)
    assert max(times.values()) == 3
    got = tokens(rows)
    assert got["big"] == 8000 and got["small"] == 900  # one pass, three passes
    a = 1 - log(3) / log(8000 / 300)
    quota = 8000 * (2250 / 8000) ** a
    assert quota - 25 < got["mid"] <= round(quota)


def test_budget(docs):
    rows = schedule(docs, Target(max_repeats=2.0, budget=5000), block_docs=16).collect()
    got = tokens(rows)
    assert 5000 - 3 * 25 < sum(got.values()) <= 5001
    assert max(Counter(r.doc_id for r in rows).values()) <= 2


def test_entropy(spark):
    sources = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 0)], "s string, tokens long")
    fit = fit_exponent(sources, Target(entropy=0.5))
    w = [1000**fit.exponent, 100**fit.exponent]
    p = [x / sum(w) for x in w]
    assert -sum(x * log(x) for x in p) == pytest.approx(0.5, abs=1e-9)
    assert fit_exponent(sources, Target(entropy=5.0)).exponent == 0
    assert fit_exponent(sources, Target(entropy=0.0)).exponent == 1


def test_epochs_are_different_permutations_of_blocks(docs):
    rows = schedule(docs, Target(max_repeats=3.0), block_docs=4).collect()
    orders = {}
    for r in rows:
        if r.source == "small":
            orders.setdefault(r.epoch, {}).setdefault(r.block, set()).add(r.doc_id)
    assert len(orders) == 3
    first, second = ([sorted(orders[e][b]) for b in sorted(orders[e])] for e in (0, 1))
    assert first != second and sorted(first) == sorted(second)


def test_same_again(docs):
    one, two = (sorted(schedule(docs, Target(max_repeats=2.5)).collect()) for _ in range(2))
    assert one == two


def test_edge_cases(make_docs):
    rows = [(None, "a b", "en", None, 1), (1, "a b", "en", "", 1), (2, None, "en", "x", 1),
            (3, "c", "en", "y", 1), (3, "c", "en", "y", 1), (4, "", "en", "y", 0)]
    docs = make_docs(rows)
    got = schedule(docs, Target(max_repeats=2.0)).collect()
    assert sorted(str(r.doc_id) for r in got if r.epoch == 0) == ["1", "2", "3", "3", "4", "None"]
    assert max(r.epoch for r in got) == 1  # two sources of 4 and 2 tokens
    assert schedule(docs.limit(0), Target(max_repeats=2.0)).count() == 0
    clash = docs.withColumnsRenamed({"lang": "tokens", "n_chars": "_x"})
    assert schedule(clash, Target(max_repeats=2.0)).count() == len(got)
    with pytest.raises(ValueError):
        Target()


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_places_of_a_hot_source_over_many_partitions(spark, many_partitions):
    blocks = spark.range(500).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("_source"),
        F.col("id").alias("_block"),
        (F.col("id") % 2).cast("int").alias("epoch"),
        F.md5(F.col("id").cast("string")).alias("_rank"),
        (F.col("id") % 11).alias("tokens"),
    )
    placed = mixing._placed(blocks)
    got = {(r._source, r.epoch, r._block): (r.block, r.before) for r in placed.collect()}
    brute, n, held = {}, Counter(), Counter()
    for r in sorted(blocks.collect(), key=lambda r: (r._source, r.epoch, r._rank, r._block)):
        group = (r._source, r.epoch)
        brute[*group, r._block] = (n[group], held[group])
        n[group] += 1
        held[group] += r.tokens
    assert got == brute


def test_salted_quotas_give_the_same_schedule(docs, monkeypatch, many_partitions):
    target = Target(max_repeats=2.5)
    broadcast = sorted(schedule(docs, target, block_docs=4).collect())
    monkeypatch.setattr(mixing, "QUOTA_BYTES", -1)
    assert sorted(schedule(docs, target, block_docs=4).collect()) == broadcast


def test_no_row_is_shuffled_by_its_source(docs, make_docs):
    plan = schedule(docs, Target(max_repeats=2.0))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_source#" in plan
    for line in plan.splitlines():
        if "hashpartitioning(_source#" in line:
            keys = line.split("hashpartitioning(")[1].split(")")[0]
            assert "_block#" in keys or "_part#" in keys or "epoch#" in keys, line
    long = make_docs([(1, "w " * 200_000), (2, "w w")])
    got = schedule(long, Target(max_repeats=1.0)).collect()
    assert sorted(r.n_tokens for r in got) == [2, 200_000]
