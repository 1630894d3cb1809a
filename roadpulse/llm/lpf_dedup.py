"""Substring dedup by longest-previous-factor arrays.

The bytes of a document that repeat a string of `length` bytes are removed. Candidates
meet by super-k-mers (see superkmers.py); in each set of buckets the packed strings are
joined with separators, their suffixes are sorted by prefix doubling, and for each suffix
the previous and the next one in suffix order with a smaller text position are its two
candidates for the longest earlier match. A suffix whose earlier match has `length` bytes
is a copy. With keep="first" copies go and the first occurrence (smallest doc_id, text hash,
position) stays; with keep="none" the earlier matches go too.

Defined results: null and empty texts have no bytes and nothing to remove; a null doc_id
is the smallest; equal rows are one document and come back as often as they came; texts
under one doc_id that differ are documents of their own; extra columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import ID, SIG
from .superkmers import Packed, Windows, byte_units, covered, ranges, unit_mask, with_spans

#: Symbols of the first sort, which is then doubled.
_FIRST_LENGTH = 8
#: Most symbols told apart by the first sort: its keys, and codes of half its length, fit 63 bits.
_MOST_CODES = 234
#: A key of two ranks and a position fits 63 bits.
_PACKED_BITS = 21
#: Bytes of the text that buckets are joined to: beyond the processor's nearer caches a byte
#: costs twice as much.
_JOINED = 1 << 16


def _first_keys(symbols: np.ndarray, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """How many symbols (up to `most`) are sorted first, a key in their order for each
    position, and where the key is of one position alone.

    A symbol that occurs once makes every prefix with it unique, so these (the separators
    among them) share the largest code."""
    n = len(symbols)
    times = np.bincount(symbols)
    several = np.flatnonzero(times > 1)
    codes = np.full(len(times), len(several) + 1, np.int64)
    codes[several] = np.arange(1, len(several) + 1)
    base = len(several) + 2
    first = _FIRST_LENGTH
    while first > most or base > _MOST_CODES ** (_FIRST_LENGTH / first):
        first //= 2
    padded = np.concatenate((codes[symbols], np.zeros(first, np.int64)))
    lone = np.concatenate(((times == 1)[symbols], np.ones(first, bool)))
    key, length = padded, 1
    while length < first:
        key = key[:-length] * base**length + key[length:]
        lone = lone[:-length] | lone[length:]
        length *= 2
    return first, key[:n], lone[:n]


def _runs_reach(inside: np.ndarray, least: int) -> np.ndarray:
    """The positions inside that lie in a run of at least so many."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    step = np.zeros(len(inside) + 1, np.int8)
    step[begin[long]] = 1
    step[end[long]] = -1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def _class_ranks(symbols: np.ndarray, length: int) -> tuple[list, np.ndarray]:
    """[(d, rank of each position by its first d symbols)], d doubling until it reaches
    `length`, and the positions that may match so far.

    A rank is the number of positions with a smaller prefix. A match of `length` symbols from
    i on has every position from i to i + length - d in a class of several by the first d
    symbols. Positions in shorter runs of such have no part in one: they part with their class
    (as its last members) and, like those alone in theirs, need no more sorting."""
    n = len(symbols)
    d, key, unique = _first_keys(symbols, length)
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])) | unique[order]
    new[1:] |= unique[order[:-1]]
    start = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((start, [n])))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, sizes)
    several = np.zeros(n, bool)
    several[order] = np.repeat(sizes > 1, sizes)
    single = symbols.astype(np.int32)
    levels = [(1, single)]
    if d > 1:
        # no sort by 2 and 4 symbols: pairs, compared as often as it takes
        after = np.concatenate((single[1:], [-1])).astype(np.int64)
        pair = symbols * (int(symbols.max()) + 2) + after + 1
        levels += [(2, pair)] * (d // 2 - 1)
        levels.append((d, rank.astype(np.int32)))
    sorted_last = active = np.flatnonzero(several)
    while d < length:
        stays = _runs_reach(several, length - d + 1)
        gone = active[~stays[active]]
        active = active[stays[active]]
        if len(gone):
            # the last places of their classes, each its own
            size = np.bincount(rank[np.concatenate((active, gone))], minlength=n)
            gone = gone[np.argsort(rank[gone])]
            old = rank[gone]
            first = np.searchsorted(old, old)
            rank[gone] = old + size[old] - 1 - (np.arange(len(gone)) - first)
        behind = active + d
        follow = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        if n < 1 << _PACKED_BITS:
            key = np.sort((((rank[active] << _PACKED_BITS) | follow) << _PACKED_BITS) | active)
            at = key & ((1 << _PACKED_BITS) - 1)
            key >>= _PACKED_BITS
            old = key >> _PACKED_BITS
        else:
            key = rank[active] * (n + 1) + follow
            order = np.argsort(key)
            key, at = key[order], active[order]
            old = rank[at]
        new_old = np.flatnonzero(np.concatenate(([True], old[1:] != old[:-1]))[: len(at)])
        new_key = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[: len(at)])
        begin_old = np.repeat(new_old, np.diff(np.concatenate((new_old, [len(at)]))))
        sizes = np.diff(np.concatenate((new_key, [len(at)])))
        rank[at] = old + np.repeat(new_key, sizes) - begin_old
        d *= 2
        levels.append((d, rank.astype(np.int32)))
        several = np.zeros(n, bool)
        several[at] = np.repeat(sizes > 1, sizes)
        sorted_last, active = active, np.flatnonzero(several)
    return levels, sorted_last


def _common_prefix(levels: list, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of positions a and b, capped by the sum of the levels."""
    n = len(levels[0][1])
    total = np.zeros(len(a), np.int64)
    for length, rank in reversed(levels):
        x, y = a + total, b + total
        inside = (x < n) & (y < n)
        same = inside & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
        total += np.where(same, length, 0)
    return total


def _previous_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest value before each one that is smaller, or -1.

    Jumps along the answers found so far; all values jumped over are larger."""
    answer = np.arange(len(values)) - 1
    open_ = np.flatnonzero(answer >= 0)
    while len(open_):
        open_ = open_[values[answer[open_]] > values[open_]]
        answer[open_] = answer[answer[open_]]
        open_ = open_[answer[open_] >= 0]
    return answer


def previous_factors(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each position the length of its longest earlier match (capped, see below) and
    where that match is.

    Prefixes are sorted to the least power-of-two depth that reaches `length`. Matches of
    `length` or more are told exactly up to twice the depth less one; shorter ones may be told
    as less than they are, down to 0."""
    n = len(symbols)
    longest, source = np.zeros(n, np.int64), np.full(n, -1)
    if not n:
        return longest, source
    levels, kept = _class_ranks(symbols.astype(np.int64), length)
    suffixes = kept[np.argsort(levels[-1][1][kept], kind="stable")]
    if not len(suffixes):
        return longest, source
    before = _previous_smaller(suffixes)
    after = len(suffixes) - 1 - _previous_smaller(suffixes[::-1])[::-1]
    for answer, there in ((before, before >= 0), (after, after < len(suffixes))):
        at = suffixes[there]
        earlier = suffixes[answer[there]]
        match = _common_prefix(levels, at, earlier)
        better = match > longest[at]
        longest[at[better]] = match[better]
        source[at[better]] = earlier[better]
    return longest, source


def _judge(length: int, keep: str):
    def judge(rows: list[Packed]) -> list[np.ndarray]:
        keys = np.array([r.key for r in rows])
        lone = np.concatenate(([True], keys[1:] != keys[:-1])) & np.concatenate(
            (keys[1:] != keys[:-1], [True])
        )
        marks = [np.zeros(r.count, bool) for r in rows]
        used = [i for i in range(len(rows)) if not lone[i]]
        if not used:
            return marks
        parts, at = [], []
        place = 0
        for number, i in enumerate(used):
            at.append(place)
            parts += [np.frombuffer(rows[i].text, np.uint8).astype(np.int64) + len(used), [number]]
            place += len(rows[i].text) + 1
        longest, source = previous_factors(np.concatenate(parts), length)
        copy = longest >= length
        marked = copy.copy()
        if keep == "none":
            marked[source[copy]] = True
        for i, a in zip(used, at, strict=True):
            marks[i] = marked[a : a + rows[i].count]
        return marks

    return judge


def _windows(length: int) -> Windows:
    """A sixth of the window for long ones: keys of 16 bytes meet by chance in prose, and
    what meets is packed and sorted."""
    m = 1
    while 2 * m <= max(min(16, length), min(64, length // 6)):
        m *= 2
    return Windows(byte_units, length, m, 0, judged=_JOINED)


def repeated_spans(
    docs: DataFrame, length: int = 400, keep: str = "first", windows: Windows | None = None
) -> DataFrame:
    """`_row` (a row of docs) and `_spans`: where strings of `length` bytes to remove start."""
    place = F.struct(F.col(ID), F.col(SIG), F.col("start"))

    def whole(head: Column, several: Column) -> Column:
        if keep == "none":
            return several
        return place != F.struct(head[ID], head[SIG], head["start"])

    def elsewhere(earliest: Column, times: Column) -> Column:
        if keep == "none":
            return times > 1
        return F.struct("doc", "sig", "at") != earliest

    windows = windows or _windows(length)
    spans = covered(docs, windows, _judge(length, keep), whole, elsewhere)
    return with_spans(docs, spans)


def removal_report(docs: DataFrame, length: int = 400, keep: str = "none") -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts, spans = batch.column("text").to_pylist(), batch.column("_spans").to_pylist()
            for text, own in zip(texts, spans, strict=True):
                raw = (text or "").encode()
                if not own:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                    continue
                gone = unit_mask(own, len(raw), length)
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append(
                    (len(raw), int(gone.sum()), len(ranges(gone)), hashlib.sha256(kept).hexdigest())
                )
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    frame = repeated_spans(docs.select("doc_id", "text"), length, keep)
    return frame.select("_row.doc_id", "_row.text", "_spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def drop_repeats(docs: DataFrame, length: int = 400, keep: str = "first") -> DataFrame:
    """docs without the repeated bytes; `n_chars`, if there, is counted anew.

    A character of which only some bytes go is dropped whole. Null texts stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column("_row").flatten(), strict=True))
            texts, spans = columns["text"].to_pylist(), batch.column("_spans").to_pylist()
            for i, own in enumerate(spans):
                if own:
                    raw = texts[i].encode()
                    gone = unit_mask(own, len(raw), length)
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    texts[i] = kept.decode(errors="ignore")
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pa.array(
                    [
                        len(t) if own else n
                        for t, own, n in zip(texts, spans, columns["n_chars"].to_pylist(), strict=True)
                    ],
                    columns["n_chars"].type,
                )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return repeated_spans(docs, length, keep).mapInArrow(run, docs.schema)
