"""The pipeline against brute force on a small fixture."""

from __future__ import annotations

import pytest

import corpus_pipeline
from roadpulse.llm.quality_rules import judge_quality
from test_decontaminate import brute as brute_contamination
from test_simhash import brute_groups
from test_substrings import brute_bytes

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    assert names == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup",
                     "benchmark_decontamination", "mixing"]
    kept = corpus_pipeline.stage(stages["quality_rules"](spark, docs, SF))
    assert kept.columns == docs.columns
    good = {r.doc_id for r in judge_quality(docs).filter("kept").collect()}
    assert {d for d, _ in rows_of(kept)} == good

    unique = corpus_pipeline.stage(stages["simhash_near_dedup"](spark, kept, SF))
    want = {c for _, _, c in brute_groups(rows_of(kept))}
    assert sorted(d for d, _ in rows_of(unique)) == sorted(want)

    cut = corpus_pipeline.stage(stages["suffix_array_dedup"](spark, unique, SF))
    before, after = dict(rows_of(unique)), dict(rows_of(cut))
    want = brute_bytes(list(before.items()), corpus_pipeline.REPEAT_BYTES, "first")
    assert before.keys() == after.keys()
    for d, (n, removed, _, _) in want.items():
        left = len(after[d].encode())
        assert n - removed - 6 <= left <= n - removed  # halves of characters go too

    clean = corpus_pipeline.stage(stages["benchmark_decontamination"](spark, cut, SF))
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {w[0] for w in brute_contamination(rows_of(cut), items)}
    assert {d for d, _ in rows_of(clean)} == after.keys() - leaks and leaks

    mixed = stages["mixing"](spark, clean, SF)
    assert mixed.columns == [*docs.columns, "n_tokens", "epoch", "block"]
    got = mixed.collect()
    assert {r.doc_id for r in got} == after.keys() - leaks
    assert sorted(got) == sorted(corpus_pipeline.run(spark, SF).collect())


def test_odd_rows_pass_every_stage(spark, make_docs, prose):
    rows = [(None, prose(1, 40)), (1, None), (2, ""), (3, prose(2, 40)), (3, prose(2, 40)),
            (4, "ü" * 100_000)]
    docs = make_docs(rows)
    for name, work in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = work(spark, given, SF)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert (out.count() == 0) == (given is not docs) or name == "mixing"


@pytest.mark.parametrize("name", ["pipeline"])
def test_registered(name):
    import __spark_entry__

    assert name in __spark_entry__.queries() and name not in __spark_entry__.oracle_sql()
