"""URL filter by a bit-parallel wildcard automaton.

All patterns are packed into one row of bits, a bit for each state of each pattern, over
as many 64-bit words as it takes. For each byte value one mask tells which states may be
entered by it (Shift-And) and one which states may stay (wildcards); a step is then the
same few word operations for all patterns and all urls of a batch.

The canonical url is '.', the host in lower case, a NUL and the path. Patterns are globs
over it: '*' is any run without a NUL, '**' any run. A rule (host, path) is the glob
`*.host NUL path**`: '*' stays in the host, so that it holds for the host and its
subdomains only. The longest rule that fits decides; among equally long ones the first.
Without one, a url is blocked if a host glob fits, else allowed.

Defined results: a null url or one without '://' has an empty host and path; a NUL in a url
matches wildcards as byte 1; equal rows are judged alike; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Cells of the byte matrix that are stepped through at once.
CELLS = 1 << 22
#: Words in host names that get a url blocked where no rule decides (a parameter).
HOST_GLOBS = ("*casino*", "*adult*", "*bets*", "*spam*", "*porn*")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[end:].partition("?")[0].partition("#")[0]
    return rest[:end].encode().lower().decode(), path


class Automaton:
    """Whole-string matching of many globs at once."""

    def __init__(self, globs: list[bytes]):
        starts, finals, enter, stay = [], [], [], []  # by state
        for glob in globs:
            starts.append(len(enter))
            enter.append(None)
            stay.append(None)
            i = 0
            while i < len(glob):
                if glob[i : i + 2] == b"**":
                    stay[-1] = "all"
                    i += 2
                elif glob[i : i + 1] == b"*":
                    stay[-1] = stay[-1] or "host"
                    i += 1
                else:
                    enter.append(glob[i])
                    stay.append(None)
                    i += 1
            finals.append(len(enter) - 1)
        self.words = -(-len(enter) // 64)
        self.begin = self._bits(starts)
        self.finals = np.array(finals)
        self.enter = np.stack([self._bits([s for s, c in enumerate(enter) if c == b])
                               for b in range(256)])
        everywhere = self._bits([s for s, kind in enumerate(stay) if kind == "all"])
        in_host = self._bits([s for s, kind in enumerate(stay) if kind])
        self.stay = np.tile(in_host, (256, 1))
        self.stay[0] = everywhere

    def _bits(self, states: list[int]) -> np.ndarray:
        out = np.zeros(self.words, np.uint64)
        for s in states:
            out[s // 64] |= np.uint64(1 << s % 64)
        return out

    def match(self, texts: list[bytes]) -> np.ndarray:
        """A row for each text, a boolean for each glob."""
        out = np.zeros((len(texts), len(self.finals)), bool)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        at = 0
        while at < len(order):
            width = max(1, len(texts[order[at]]))
            some = order[at : at + max(1, CELLS // width)]
            state = self._run([texts[i] for i in some])
            words = state[:, self.finals // 64]
            out[some] = words >> (self.finals % 64).astype(np.uint64) & np.uint64(1) != 0
            at += len(some)
        return out

    def _run(self, texts: list[bytes]) -> np.ndarray:
        """The states after texts that are ordered from the longest to the shortest."""
        lengths = np.array([len(t) for t in texts])
        cells = np.zeros((len(texts), lengths[0] if len(lengths) else 0), np.uint8)
        for i, t in enumerate(texts):
            cells[i, : len(t)] = np.frombuffer(t, np.uint8)
        state = np.tile(self.begin, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        for step in range(cells.shape[1]):
            n = int(np.searchsorted(-lengths, -step))  # those longer than step
            now, byte = state[:n], cells[:n, step]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:n] = (moved & self.enter[byte]) | (now & self.stay[byte])
        return state


def judge_urls(
    pages: DataFrame, rules: list[Rule], host_globs: tuple[str, ...] = HOST_GLOBS
) -> DataFrame:
    """`page_id`, `host`, `path`, `rule` (null without one), `verdict` for each row."""
    ranked = sorted(rules, key=lambda r: -len(r.name))  # stable: the first of equals
    globs = [f"*.{r.host}\0{r.path}**".encode() for r in ranked]
    globs += [f"{g}\0**".encode() for g in host_globs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(globs)
        for batch in batches:
            parts = [split_url(u) for u in batch.column("url").to_pylist()]
            canonical = [
                b".%b\0%b" % (h.encode().replace(b"\0", b"\1"), p.encode().replace(b"\0", b"\1"))
                for h, p in parts
            ]
            fits = automaton.match(canonical)
            names, verdicts = [], []
            for row in fits:
                own = np.flatnonzero(row)
                if len(own) and own[0] < len(ranked):
                    names.append(ranked[own[0]].name)
                    verdicts.append(ranked[own[0]].verdict)
                else:
                    names.append(None)
                    verdicts.append("block" if len(own) else "allow")
            hosts, paths = zip(*parts, strict=True) if parts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"),
                 *(pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts))],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    return pages.select("page_id", "url").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )
