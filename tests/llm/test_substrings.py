"""Both substring operators against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from roadpulse.llm import lpf_dedup, superkmers
from roadpulse.llm.lpf_dedup import (
    drop_repeats,
    previous_factors,
    removal_report,
    repeated_spans,
)
from roadpulse.llm.superkmers import Windows, byte_units, unit_mask, word_units
from roadpulse.llm.window_dedup import window_report

SF = "/root/testdata/sf0.001"


def brute_bytes(rows, length, keep):
    """(n_bytes, n_removed, n_spans, sha) by document; rows have different ids."""
    starts = defaultdict(list)
    texts = {d: (t or "").encode() for d, t in rows}
    for d in sorted(texts):
        for i in range(len(texts[d]) - length + 1):
            starts[texts[d][i : i + length]].append((d, i))
    gone = {d: np.zeros(len(t), bool) for d, t in texts.items()}
    for places in starts.values():
        if len(places) > 1:
            for d, i in places if keep == "none" else places[1:]:
                gone[d][i : i + length] = True
    out = {}
    for d, t in texts.items():
        kept = bytes(b for b, g in zip(t, gone[d], strict=True) if not g)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone[d].astype(int)))) == 1)
        out[d] = (len(t), int(gone[d].sum()), len(edges), hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, size):
    texts = {d: (t or "").encode().split() for d, t in rows}
    first = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - size + 1):
            first.setdefault(tuple(texts[d][i : i + size]), d)
    out = {}
    for d, w in texts.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(scope="module")
def shared_rows(prose):
    passage, other = prose(1, 90), prose(2, 70)
    rows = [(i, prose(100 + i, 120)) for i in range(12)]
    rows += [
        (20, f"{prose(30, 15)} {passage} {prose(31, 9)}"),
        (21, f"{prose(32, 5)} {passage}"),
        (22, f"{passage} {prose(33, 40)} {other} {prose(34, 3)} {other}"),
        (23, rows[3][1]),
        (24, rows[3][1]),
        (25, rows[4][1][:300] + " xx " + rows[4][1][300:]),
        (26, "ab " * 200),
        (27, "a" * 500),
        (28, "a" * 300 + "é" * 200),
        (29, None),
        (30, ""),
        (31, "one"),
        (32, " \n" + other.replace(" ", "\n\t") + " "),
    ]
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
def test_bytes_against_brute_force(make_docs, shared_rows, keep):
    got = {r[0]: tuple(r)[1:] for r in removal_report(make_docs(shared_rows), 60, keep).collect()}
    assert got == brute_bytes(shared_rows, 60, keep)


def test_words_against_brute_force(make_docs, shared_rows):
    got = {r[0]: tuple(r)[1:4] for r in window_report(make_docs(shared_rows), 20).collect()}
    assert got == brute_words(shared_rows, 20)


def test_crowded_buckets_are_counted_by_window(make_docs, shared_rows):
    """Every bucket takes the path for any size; the results stay."""
    docs = make_docs(shared_rows)
    small = Windows(word_units, 20, 4, 1, bucket_rows=0)
    got = {r[0]: tuple(r)[1:4] for r in window_report(docs, 20, small).collect()}
    assert got == brute_words(shared_rows, 20)
    for keep in ("none", "first"):
        spans = repeated_spans(docs, 60, keep, Windows(byte_units, 60, 16, 0, bucket_rows=0))
        gone = {r.doc_id: r for r in spans.select("_row.doc_id", "_spans").collect()}
        for d, (n, removed, _, _) in brute_bytes(shared_rows, 60, keep).items():
            assert int(unit_mask(gone[d]._spans, n, 60).sum()) == removed, (d, keep)


def test_long_documents_are_cut_in_pieces(make_docs, shared_rows, monkeypatch):
    monkeypatch.setattr(superkmers, "CHUNK", 64)
    windows = Windows(byte_units, 60, 16, 0)
    for _, text in shared_rows:
        raw = (text or "").encode()
        cut = [(f, c) for f, c, _, _ in windows.cut(raw)]
        starts = [f + i for f, c in cut for i in range(c)]
        assert starts == list(range(max(0, len(raw) - 59)))


@pytest.mark.parametrize("seed", range(4))
def test_previous_factors_against_brute_force(seed):
    s = np.random.default_rng(seed).integers(0, 2 + seed, 300)
    s[200:250] = s[20:70]
    longest, source = previous_factors(s, 16)
    for i in range(len(s)):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            best = max(best, n)
        assert (longest[i] >= 16) == (best >= 16)
        if best >= 16:
            n = min(best, 31)  # 16 + 8 + 4 + 2 + 1
            assert longest[i] == n
            at = source[i]
            assert at < i and (s[at : at + n] == s[i : i + n]).all()


def with_copies(rng, size):
    """Symbols with copied stretches and some that occur once, as separators do."""
    s = rng.integers(0, rng.integers(1, 6), size)
    for _ in range(4):
        a, b = rng.integers(0, size, 2)
        n = min(int(rng.integers(1, 90)), size - max(a, b))
        s[b : b + n] = s[a : a + n].copy()
    once = rng.integers(0, size, 3)
    s[once] = 300 + np.arange(3)
    return s


@pytest.mark.parametrize("length", [1, 2, 3, 5, 8, 9, 16, 40])
@pytest.mark.parametrize("limits", [{}, {"_PACKED_BITS": 3}, {"_MOST_CODES": 4}])
def test_copies_of_any_length_against_brute_force(length, limits, monkeypatch):
    """Also with keys too wide to pack and with too many symbols for the first sort."""
    for name, value in limits.items():
        monkeypatch.setattr(lpf_dedup, name, value)
    for seed in range(30):
        s = with_copies(np.random.default_rng(seed), 250)
        places = defaultdict(list)
        for i in range(len(s) - length + 1):
            places[s[i : i + length].tobytes()].append(i)
        later = {i for p in places.values() for i in p[1:]}
        earlier = {p[0] for p in places.values() if len(p) > 1}
        longest, source = previous_factors(s, length)
        copy = np.flatnonzero(longest >= length)
        assert set(copy.tolist()) == later, seed
        assert earlier <= set(source[copy].tolist()) <= earlier | later, seed


def test_only_long_runs_are_sorted_on(prose):
    """Prose shares short strings everywhere; the sort goes on with copies alone."""
    passage = prose(70, 90)
    text = f"{prose(71, 2000)} {passage} {prose(72, 2000)} {passage} {prose(73, 2000)}"
    symbols = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    _, last = lpf_dedup._class_ranks(symbols, 400)
    first = text.index(passage)
    own = set(range(first - 20, first + len(passage) + 20))
    own |= {i + text.rindex(passage) - first for i in own}
    assert len(passage) > 400 and len(last) and set(last.tolist()) <= own


def test_common_phrases_do_not_make_long_windows_meet(prose):
    """Keys of 400-byte windows are longer than a phrase: nothing of these texts is packed."""
    phrase = prose(80, 12)[:40]
    windows = lpf_dedup._windows(400)
    docs = defaultdict(set)
    for n in range(60):
        text = " ".join(f"{prose(1000 + 10 * n + i, 12)} {phrase}" for i in range(10))
        for _, _, key, _ in windows.cut(text.encode()):
            docs[key].add(n)
    assert docs and not any(len(d) > 1 for d in docs.values())
    assert windows.m == 64 and lpf_dedup._windows(240).m == 32 and lpf_dedup._windows(60).m == 16


def test_test_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = {r[0]: tuple(r)[1:] for r in removal_report(docs, 400, "none").collect()}
    assert got == brute_bytes(rows, 400, "none")
    got = {r[0]: tuple(r)[1:4] for r in window_report(docs, 50).collect()}
    assert got == brute_words(rows, 50)


def test_edge_cases(make_docs, spark, prose):
    text = prose(5, 80)
    docs = make_docs([(None, text), (3, text), (3, text), (4, text + " end"), (5, None)])
    words = sorted(window_report(docs, 20).select("doc_id", "n_removed").collect(), key=str)
    assert [tuple(r) for r in words] == [(3, 80), (3, 80), (4, 80), (5, 0), (None, 0)]
    clean = {(r.doc_id, r.text) for r in drop_repeats(docs, 60).collect()}
    assert (None, text) in clean and (3, "") in clean and (5, None) in clean
    empty = docs.limit(0)
    assert removal_report(empty, 60).count() == 0 and window_report(empty, 20).count() == 0
    clash = docs.withColumnsRenamed({"lang": "_doc", "source": "key"})
    assert drop_repeats(clash.withColumn("spans", clash["key"]), 60).count() == 5


@pytest.mark.parametrize("bucket_rows", [8192, 0])
@pytest.mark.parametrize("keep", ["none", "first"])
def test_equal_rows_are_one_document(make_docs, prose, keep, bucket_rows):
    """Beside a document that shares a phrase, so that buckets have several classes."""
    phrase = prose(40, 30)
    rows = [(1, f"{prose(41, 30)} {phrase} {prose(42, 30)}"), (2, f"{prose(43, 30)} {phrase} {prose(44, 9)}")]
    windows = Windows(byte_units, 60, 16, 0, bucket_rows=bucket_rows)
    spans = repeated_spans(make_docs([rows[0], *rows]), 60, keep, windows)
    want = {d: r[1] for d, r in brute_bytes(rows, 60, keep).items()}
    texts = dict(rows)
    got = [
        (r.doc_id, int(unit_mask(r._spans, len(texts[r.doc_id]), 60).sum()))
        for r in spans.select("_row.doc_id", "_spans").collect()
    ]
    assert sorted(got) == sorted([(1, want[1]), *want.items()]) and want[2] >= 60


@pytest.mark.parametrize("bucket_rows", [8192, 0])
def test_texts_under_one_id_are_copies_of_each_other(make_docs, prose, bucket_rows):
    """The copy is at the same place in both texts; the phrase of a third one makes buckets
    with several classes."""
    start = prose(50, 40)
    docs = make_docs([(i, f"{start} {prose(51 + n, 30)}") for n, i in enumerate((None, None, 5, 5))]
                     + [(9, prose(60, 5) + start[30:])])
    windows = Windows(byte_units, 60, 16, 0, bucket_rows=bucket_rows)
    rows = repeated_spans(docs, 60, "first", windows).select("_row.doc_id", "_row.text", "_spans").collect()
    gone = [(r.doc_id, int(unit_mask(r._spans, len(r.text), 60).sum())) for r in rows]
    assert sorted(n >= len(start) for d, n in gone if d is None) == [False, True]
    assert sorted(n for d, n in gone if d is None)[0] == 0
    assert all(n >= len(start) for d, n in gone if d == 5)
