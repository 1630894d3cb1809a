"""SimHash near-dedup against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from roadpulse.llm.simhash import (
    _cell_masks,
    blocks_for,
    drop_near_copies,
    fingerprint,
    fingerprint_links,
    simhash_groups,
    spanning_links,
    unary_counts,
)

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    spans = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in spans]
    bits = [2 * sum(h >> b & 1 for h in hashes) > len(hashes) for b in range(64)]
    return sum(1 << b for b, on in enumerate(bits) if on and hashes)


def brute_groups(rows, max_bits=4):
    marks = [(d, brute_fingerprint(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(marks[i][1] ^ marks[j][1]).count("1") <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(marks):
        least[find(i)] = min(least.get(find(i), d), d)
    return {(d, f"{m:016x}", least[find(i)]) for i, (d, m) in enumerate(marks)}


def test_test_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert {tuple(r) for r in simhash_groups(docs).collect()} == brute_groups(rows)


@pytest.mark.parametrize("text", [None, "", "A b", "É É\x0b\x0c x y Z", "a b c d", "a b   c d e f g"])
def test_fingerprints(text):
    assert fingerprint((text or "").encode(), 4) == brute_fingerprint(text)


def close_marks(n, seed=0):
    """Chains and clusters of near fingerprints, and unrelated ones."""
    r = np.random.default_rng(seed)
    marks = list(r.integers(0, 1 << 64, n, dtype=np.uint64))
    for i in range(n):
        mark = int(marks[i % (n // 4)])
        for _ in range(r.integers(1, 6)):
            mark ^= 1 << int(r.integers(0, 64))
        marks.append(np.uint64(mark))
    return np.unique(np.array(marks, np.uint64))


def brute_components(marks, max_bits):
    near = np.bitwise_count(marks[:, None] ^ marks[None, :]) <= max_bits
    label = np.arange(len(marks))
    while True:
        new = np.where(near, label[None, :], len(marks)).min(axis=1)
        if (new == label).all():
            return label
        label = new


def joined(marks, links):
    label = {int(m.view(np.int64)): i for i, m in enumerate(marks)}
    root = np.arange(len(marks))
    changed = True
    while changed:
        changed = False
        for u, v in links:
            a, b = root[label[u]], root[label[v]]
            if a != b:
                root[label[u]] = root[label[v]] = min(a, b)
                changed = True
    return root


def test_spanning_links_connect_what_is_near():
    marks = close_marks(120)
    links = spanning_links(marks, 4)
    assert len(links) < len(marks)
    assert (joined(marks, links) == brute_components(marks, 4)).all()


@pytest.mark.parametrize("blocks,tile", [(6, 4096), (7, 4096), (6, 3)])
def test_all_links_are_found(spark, blocks, tile):
    """Also where every cell with over three members is dealt out in tiles."""
    marks = close_marks(150, seed=blocks + tile)
    frame = spark.createDataFrame([(int(m),) for m in marks.view(np.int64)], "fp long")
    links = [tuple(r) for r in fingerprint_links(frame, 4, blocks, tile).collect()]
    assert (joined(marks, links) == brute_components(marks, 4)).all()


def test_blocks_grow_with_the_number_of_fingerprints():
    sizes = [blocks_for(10**e, 4) for e in range(3, 11)]
    assert sizes[0] == 6 and sizes == sorted(sizes) and sizes[-1] > 6
    assert len(_cell_masks(7, 4)) == 35


def test_edge_cases(make_docs, prose):
    text = prose(1, 60)
    docs = make_docs([(7, text), (7, text), (9, text + "."), (2, None), (None, ""), (4, " \n")])
    got = sorted(((r.doc_id, r.component_id) for r in simhash_groups(docs).collect()), key=str)
    assert got == [(2, None), (4, None), (7, 7), (7, 7), (9, 7), (None, None)]
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["7", "None"]
    assert simhash_groups(docs.limit(0)).count() == 0 and drop_near_copies(docs.limit(0)).count() == 0
    clash = docs.withColumnsRenamed({"lang": "fp", "source": "_kept"}).drop("n_chars")
    assert drop_near_copies(clash).count() == 2


def test_one_document_of_each_group_stays(make_docs, prose):
    """Also where the first documents of several groups have no id, or the same one."""
    a, b, c, d, e = (prose(i, 60) for i in range(20, 25))
    rows = [(None, a), (None, b), (1, a), (2, b), (5, c), (5, d), (5, d), (6, c), (7, d), (8, e)]
    kept = [(r.doc_id, r.text) for r in drop_near_copies(make_docs(rows)).collect()]
    assert sorted(kept, key=str) == sorted([(None, a), (None, b), (5, c), (5, d), (8, e)], key=str)


def test_the_row_that_stays_is_the_first_of_its_group(make_docs, prose):
    """A text under the id of a group's first document that lies in another group with a
    smaller id goes."""
    a, b = prose(30, 60), prose(31, 60)
    docs = make_docs([(1, a), (3, a), (3, b), (4, b)])
    kept = [(r.doc_id, r.text) for r in drop_near_copies(docs).collect()]
    assert sorted(kept) == [(1, a), (3, b)]


def test_unary_counts_give_the_manhattan_distance_below_the_hamming_distance():
    r = np.random.default_rng(5)
    marks = r.integers(0, 2**64, 200, np.uint64)
    marks[100:] = marks[:100] ^ (np.uint64(1) << r.integers(0, 64, 100, np.uint64))
    vectors = unary_counts(marks)
    counts = np.array([[int(m) >> 2 * s & 1 for s in range(32)] for m in marks]) + np.array(
        [[int(m) >> 2 * s + 1 & 1 for s in range(32)] for m in marks]
    )
    for a in range(0, 200, 7):
        manhattan = np.abs(counts - counts[a]).sum(axis=1)
        assert (np.bitwise_count(vectors ^ vectors[a]) == manhattan).all()
        assert (manhattan <= np.bitwise_count(marks ^ marks[a])).all()
