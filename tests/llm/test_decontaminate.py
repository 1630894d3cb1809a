"""Containment search against brute force."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

from roadpulse.llm.decontaminate import contamination, drop_contaminated
from roadpulse.llm.sql import contamination as statement


def brute(docs, items, threshold=0.8):
    def words(text):
        return "".join(c.lower() if c.isascii() else c for c in text or "").split()

    def runs(own, width):
        return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}

    wanted = []
    for i, x in items:
        own = words(x)
        if own:
            width = min(5, len(own))
            wanted.append((i, width, runs(own, width)))
    out = set()
    for d, t in docs:
        own = words(t)
        held = {width: runs(own, width) for width in {w for _, w, _ in wanted}}
        for i, width, other in wanted:
            common = len(held[width] & other)
            if common >= threshold * len(other) - 1e-9:
                out.add((d, i, len(other), common))
    return out


@pytest.fixture(scope="module")
def tables(prose):
    r = random.Random(3)
    items = [(i, prose(1000 + i, r.choice([2, 3, 4, 5, 9, 14, 30, 60, 120]))) for i in range(25)]
    items += [(50, None), (51, " "), (None, prose(7, 20)), (52, items[4][1])]
    docs = []
    for d in range(80):
        text = prose(d, r.choice([0, 4, 50, 900])).split()
        if d % 2:
            words = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, 4)):  # some near the threshold, some beyond
                if words:
                    words[r.randrange(len(words))] = "changed"
            at = r.randint(0, len(text))
            text[at:at] = words
        docs.append((d, " ".join(text).title() if d % 3 == 0 else "\n".join(text)))
    docs += [(90, None), (91, ""), (None, items[3][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_against_brute_force(spark, make_docs, tables, block_bytes):
    docs, items = tables
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert 10 < len(want) < len(docs) * len(items)
    got = contamination(make_docs(docs), benchmark, block_bytes=block_bytes).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    kept = drop_contaminated(make_docs(docs), benchmark, block_bytes=block_bytes).collect()
    assert {r.doc_id for r in kept} == {d for d, _ in docs} - {w[0] for w in want}


def test_short_items_inside_long_texts(spark, make_docs, prose):
    """Items of one to four words are runs of just these words; a part of a word is none."""
    text = prose(1, 20_000).split()
    text[12_345:12_345] = ["Zebra", "quartz\n", "VEX"]
    docs = [(1, " ".join(text)), (2, "zebra quartz"), (3, "quartz vex zebra"), (4, "zebras"), (5, None)]
    items = [(1, "zebra quartz vex"), (2, "quartz\tvex"), (3, "zebra"), (4, "vex quartz zebra vex")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in contamination(make_docs(docs), benchmark).collect()}
    assert got == {(1, 1, 1, 1), (1, 2, 1, 1), (3, 2, 1, 1)} | {(d, 3, 1, 1) for d in (1, 2, 3)}
    assert got == brute(docs, items)


def test_statement_agrees_on_short_items(spark, make_docs, tables):
    docs, items = tables
    db = duckdb.connect()
    for name, key, data in [("documents", "doc_id", docs), ("benchmark", "item_id", items)]:
        frame = pd.DataFrame(data, columns=[key, "text"]).astype({key: "Int64"})
        db.register(f"{name}_rows", frame)
        db.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_rows")
    names = ["doc_id", "item_id", "n_shingles", "n_common"]
    stated = db.execute(f"SELECT {', '.join(names)} FROM ({statement()}) WHERE item_id IS NOT NULL")
    want = {w for w in brute(docs, items) if w[0] is not None and w[1] is not None}
    assert {w for w in stated.fetchall() if w[0] is not None} == want
    assert min(len((x or "").split()) for i, x in items if i in {w[1] for w in want}) < 5


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, "a b c d e f"), (1, "a b c d e f"), (2, None)])
    benchmark = spark.createDataFrame(
        [(5, "A B C D E F", 1), (5, "A B C D E F", 2)], "item_id long, text string, doc_id long"
    )
    assert [tuple(r) for r in contamination(docs, benchmark).collect()] == [(1, 5, 2, 2)] * 2
    clash = docs.withColumnsRenamed({"lang": "item_id", "source": "_found"})
    kept = drop_contaminated(clash, benchmark)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [2]
    nothing = benchmark.limit(0)
    assert contamination(docs, nothing).count() == 0 and drop_contaminated(docs, nothing).count() == 3
    assert contamination(docs.limit(0), benchmark).count() == 0
