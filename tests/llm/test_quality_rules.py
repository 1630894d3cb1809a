"""Quality rules: base counts by brute force, distances by hand, edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from roadpulse.llm.quality_rules import drop_poor, judge_quality

TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "a b c d e",
    "a b c d e a b c d e",
    "the same five words here " * 4,
    "x x x x x x x",
    "line one\nline one\n\n\n \nline two\nline one ",
    "#a $b %c & | <d> é ü 漢字 😀 end",
    "A\x0bB\x0cC\rD",
    "w1 w2 w3 w4 w5 w6 w1 w2 w3 w4 w5 z w2 w3 w4 w5 w6",
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def test_base_counts(make_docs, prose):
    texts = [*TEXTS, *(prose(i, 30 * i) for i in range(1, 5))]
    got = judge_quality(make_docs(list(enumerate(texts)))).collect()
    for row in got:
        assert tuple(row)[1:7] == brute(texts[row.doc_id]), texts[row.doc_id]


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    parts = [x * math.log2(x / y) for ps in (p, q) for x, y in zip(ps, m, strict=True) if x > 0]
    return math.sqrt(max(0.0, sum(parts) / 2))


def test_distances(make_docs):
    from roadpulse.llm.quality_rules import CLASS_SHARES, WORD_SHARES

    text = "The cat of the house, and THE dog. " * 12
    row = judge_quality(make_docs([(1, text)])).first()
    n, words = len(text), text.split()
    upper = sum(c.isupper() for c in text)
    marks = sum(c in ",." for c in text)
    spaces = text.count(" ")
    by_class = [spaces, upper, 0, marks, 0, n - spaces - upper - marks]
    assert row.class_distance == pytest.approx(
        distance([x / n for x in by_class], CLASS_SHARES["en"]), abs=1e-12
    )
    shares = WORD_SHARES["en"]
    bare = [w.lower().rstrip(".,") for w in words]
    hits = [bare.count(w) for w in shares]
    p = [x / len(words) for x in [*hits, len(words) - sum(hits)]]
    assert row.word_distance == pytest.approx(
        distance(p, [*shares.values(), 1 - sum(shares.values())]), abs=1e-12
    )


def test_guards_and_languages(make_docs):
    rows = [
        (1, "short $$$ ### &&& *** text of eleven words that is kept", "en", "a", 1),
        (2, "die und der von zu das mit sich des auf Haus Hof " * 6, None, "a", 1),
        (3, "die und der von zu das mit sich des auf Haus Hof " * 6, "xx", "a", 1),
    ]
    got = {r.doc_id: r for r in judge_quality(make_docs(rows)).collect()}
    assert got[1].class_distance is None and got[1].word_distance is None and got[1].kept
    assert got[2].word_distance == got[3].word_distance


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = judge_quality(docs).join(labels, "doc_id").filter("not base_failed")
    rates = {r.quality: r.rate for r in got.groupBy("quality").agg({"kept": "count"}).join(
        got.selectExpr("quality", "int(kept) k").groupBy("quality").avg("k")
        .toDF("quality", "rate"), "quality").collect()}
    assert rates[1] > 0.99 and rates[0] < 0.1


def test_no_python_and_no_shuffle(make_docs):
    plan = judge_quality(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "Exchange"):
        assert word not in plan


def test_edge_cases(make_docs, prose):
    docs = make_docs([(None, None), (1, prose(1, 50)), (1, prose(1, 50))])
    assert drop_poor(docs).columns == docs.columns
    assert [r.doc_id for r in drop_poor(docs).collect()] == [1, 1]
    assert judge_quality(docs.limit(0)).count() == 0 and drop_poor(docs.limit(0)).count() == 0
    clash = docs.withColumnsRenamed({"lang": "_row", "source": "kept"}).withColumn(
        "n_words", docs["n_chars"]
    )
    assert drop_poor(clash).columns == clash.columns and drop_poor(clash).count() == 2
