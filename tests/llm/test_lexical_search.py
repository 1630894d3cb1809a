"""Ranked search against a score of every document."""

from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import pytest

from roadpulse.llm.lexical_search import Block, ranked_documents, terms, weight


def _terms(text):
    folded = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, k):
    counts = [(d, Counter(_terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for (d, c), n in zip(counts, sizes, strict=True):
            score = 0
            for t in set(_terms(text)) & c.keys():
                w = floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 50 + 50 * n * n_docs // n_terms
                score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is not None, d or 0))
        scored.sort()
        out += [(item, r, d if known else None, -s) for r, (s, known, d) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    vocabulary = ["".join(r.choices("abcdeéß", k=r.randint(1, 5))) for _ in range(300)]
    common = ["the", "of", "and"]

    def text(n):
        return r.choice([" ", "-", ".\n"]).join(
            r.choice([str.upper, str])(r.choice(common if r.random() < 0.3 else vocabulary))
            for _ in range(n)
        )

    docs = [(i, text(r.choice([1, 5, 40, 300]))) for i in range(150)]
    docs += [(i, docs[3][1]) for i in range(200, 240)]  # ties
    docs += [(5, docs[5][1]), (5, text(30)), (None, docs[3][1]), (None, None), (300, ""), (301, ". -")]
    items = [(i, text(r.choice([1, 8, 30]))) for i in range(20)]
    items += [(3, text(9)), (4, items[4][1]), (50, None), (51, "--"), (None, text(10)), (52, "the")]
    return docs, [x for x in items]


@pytest.mark.parametrize(
    "k, width, block_bytes, vocabulary_bytes",
    [(50, 1024, 1 << 20, 1 << 20), (5, 16, 200, 1 << 20), (7, 1, 100, 400)],
)
def test_against_brute_force(spark, make_docs, corpus, k, width, block_bytes, vocabulary_bytes):
    docs, items = corpus
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = ranked_documents(
        make_docs(docs).repartition(5), benchmark, k, width, block_bytes, vocabulary_bytes
    )
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, [x for x in items if x[1]], k)


def test_bounds_hold_and_skip_documents(corpus):
    """No bound is below a score, and most documents are never rescored."""
    import numpy as np

    docs, items = corpus
    words = sorted({t for _, text in items for t in terms(text or "")})
    number = {t: i for i, t in enumerate(words)}
    own = [(i, np.array(sorted({number[t] for t in terms(x or "")}), np.int64)) for i, x in items]
    weights = np.array([weight(len(docs), 3 + i % 40) for i in range(len(words))], np.int64)
    block = Block(own, number, weights, len(docs), 10_000, 3, 256)
    seen = []
    rescore = block._rescore

    def watched(q, bound, ids, keys, impacts, best, least):
        wanted = np.arange(len(ids))[:, None] * len(words) + own[q][1]
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        exact = np.where(keys[place] == wanted, impacts[place], 0).sum(1)
        assert (bound >= exact).all()
        rescore(q, bound, ids, keys, impacts, best, least)
        seen.append((bound >= least[q]).mean())

    block._rescore = watched
    counts = [Counter(map(number.get, terms(t or ""))) for _, t in docs]
    lists = [sorted((k, v) for k, v in c.items() if k is not None) for c in counts]
    batch = (
        [d for d, _ in docs],
        np.array([len(terms(t or "")) for _, t in docs]),
        np.cumsum([0] + [len(x) for x in lists]),
        np.array([k for x in lists for k, _ in x]),
        np.array([v for x in lists for _, v in x]),
    )
    block.search(iter([batch]))
    assert seen and sum(seen) / len(seen) < 0.5


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, "a b"), (1, "a b"), (2, "c " * 50_000 + "a")])
    items = spark.createDataFrame([(7, "A a", 1)], "item_id long, text string, doc_id long")
    clash = docs.withColumnsRenamed({"lang": "item_id", "source": "score"})
    got = [tuple(r) for r in ranked_documents(clash, items).orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(7, 1, 1), (7, 2, 1), (7, 3, 2)]
    assert ranked_documents(docs, items.limit(0)).count() == 0
    assert ranked_documents(docs.limit(0), items).count() == 0
    assert ranked_documents(make_docs([(1, None), (2, "")]), items).count() == 0
