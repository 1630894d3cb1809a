"""License scan against a plain-Python reading of its rules."""

from __future__ import annotations

import random
import re

from roadpulse.llm.license_rules import (
    BASE,
    SEPARATORS,
    STEMS,
    WEIGHTS,
    license_report,
    scan_licenses,
    signatures,
)

RULES = signatures()


def _norm(text):
    return "".join(f" {w} " for w in re.split(SEPARATORS, (text or "").lower()) if w)


def _spans(norm, regex):
    return [
        (norm[: m.start()].count(" ") // 2, norm[: m.end()].count(" ") // 2)
        for m in re.finditer(regex, norm)
    ]


def brute(text):
    norm = _norm(text)
    found = sorted(
        (a, -b, i) for i, r in enumerate(RULES) for a, b in _spans(norm, r.regex)
    )
    kept = []
    for a, minus, i in found:
        b, priority = -minus, RULES[i].priority
        if kept and a < kept[-1][1]:
            last = RULES[kept[-1][2]].priority
            if priority < last:
                kept.pop()
            elif b <= kept[-1][1] or priority > last:
                continue
        kept.append((a, b, i))
    words = re.split(SEPARATORS, (text or "").lower())
    words = [w for w in words if w]
    base = [
        (label, i)
        for label, phrase in BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    return words, base, [(RULES[i].label, RULES[i].kind, a, b) for a, b, i in kept]


def _example(rule, r):
    """A text that the rule matches: its own pattern with a choice made everywhere."""
    pattern = rule.pattern
    while True:
        inner = re.search(r"\(([^()]*)\)(\?|\{(\d+),\d+\})?", pattern)
        if not inner:
            break
        pick = r.choice(inner[1].split("|"))
        if inner[2] == "?" and r.random() < 0.5:
            pick = ""
        elif inner[3]:
            pick = pick * int(inner[3])
        pattern = pattern[: inner.start()] + pick + pattern[inner.end() :]
    pattern = re.sub(r"(\S+)\{\d+,\d+\}", r"\1", pattern)
    pattern = re.sub(r" ?\S+\?", "", pattern) if "?" in pattern else pattern
    pattern = pattern.replace("licen[cs]e", "license").replace("[cs]", "s")
    return pattern.replace(r"\S+", "foo").replace(r"\d\d", "17")


def test_rules_are_hundreds_and_gated_by_their_words():
    assert len(RULES) > 200 and {r.kind for r in RULES} == set(WEIGHTS)
    r = random.Random(5)
    for rule in RULES:
        for _ in range(4):
            norm = _norm(_example(rule, r))
            match = re.search(rule.regex, norm)
            assert match, (rule, norm)
            assert rule.keyword in match.group(), rule
            single = match.group().replace("  ", " ")
            assert any(re.search(s, single) for s in STEMS), rule


def test_against_brute_force(spark, make_docs, prose):
    r = random.Random(11)
    docs = [(0, None), (1, ""), (2, " .,; "), (None, "MIT License"), (3, "mit license " * 700)]
    phrases = [p for _, p in BASE] + ["the foo license", "gnu", "cc by-nc 4.0 international"]
    for i in range(4, 200):
        text = prose(i, r.choice([0, 3, 40])).split()
        for _ in range(r.randint(1, 6)):
            piece = _example(r.choice(RULES), r) if r.random() < 0.7 else r.choice(phrases)
            text[(at := r.randint(0, len(text))) : at] = [
                r.choice([str.title, str.upper, str])(piece).replace(" ", r.choice([" ", "-", "\n"]))
            ]
        docs.append((i, r.choice([" ", ", ", "é "]).join(text)))
    got = {
        row.doc_id: row
        for row in license_report(make_docs(docs)).collect()
    }
    spans = {
        row.doc_id: [tuple(x) for x in row._scan.found]
        for row in scan_licenses(make_docs(docs)).collect()
    }
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words, base, found = brute(text)
        places = [i for _, i in base]
        labels = {label for label, _ in base}
        assert tuple(got[doc_id]) == (
            doc_id, len(words), len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)), ",".join(sorted(labels | {f[0] for f in found})),
            max((WEIGHTS[f[1]] for f in found), default=0.0), len(found),
        ), text
        assert spans[doc_id] == found, text


def test_edge_cases(spark, make_docs):
    docs = make_docs([(1, "MIT License"), (1, "MIT License")])
    clash = docs.withColumnsRenamed({"lang": "_scan", "source": "label"})
    out = scan_licenses(clash)
    assert out.columns == ["doc_id", "text", "label", "n_chars", "_scan"]
    assert [r._scan.n_words for r in out.collect()] == [2, 2]
    assert license_report(docs.limit(0)).collect() == []
    plan = license_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
