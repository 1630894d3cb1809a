"""License scan by ordered signature rules, in built-in functions only.

A text becomes its lower-cased words, each with a space on either side, so that a rule is
a regular expression over whole words. Three steps, all within the row (no shuffle):

1. Keyword prefilter: a text with none of `STEMS` is not looked at further; in the others
   a rule is tried only if its own keyword occurs, and located only if it matches.
2. Detection: what is between the matches of a rule (split) and the matches themselves
   (extract) give the word spans, in the order of the text.
3. Suppression: one sweep over the spans by start, longest first, earlier rule first. A
   span within the one before goes, unless it has a better priority: then the one before
   goes. Of two that overlap the better priority stays; with equal ones both stay.

Priorities: 1 a license named by a statement, a tag, a title with version or its own words,
2 a title alone, 3 a sentence on licensing that names none known.

Defined results: a null or empty text has no words and no detections, score 0; equal rows
are judged alike; extra columns pass through, but for one named `_scan`, which is replaced;
a text of any length is scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What parts words, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: One of these is in every match of a rule. Each is searched as a pattern of its own, which
#: Java does by leaps (Boyer-Moore); one pattern of alternatives would look at every character.
STEMS = (
    "licen", "spdx", "copyright", "copyleft", " gnu ", "gpl", " cc0? ", "creative", "domain",
    "permission", "redistribut", "misrepresented", "contributors", "advertising", "mozilla",
    "unencumbered", "wtfpl", "confidential", "openrail",
)
#: Words that tell little, so that a rule is not gated by them if it has another.
COMMON = frozenset("license public open software under version the this terms agreement".split())

#: Score of a detection by kind.
WEIGHTS = {"tag": 1.0, "text": 1.0, "statement": 0.9, "title": 0.6, "hint": 0.3}


@dataclass(frozen=True)
class Signature:
    """One rule. `pattern` is over words: a space parts words, `( | )?` group, `\\S+` is any
    word."""

    label: str
    kind: str
    pattern: str
    priority: int

    @property
    def keyword(self) -> str:
        """The longest word that every match holds, a space on either side (or a space)."""
        outside = self.pattern
        while outside != (less := re.sub(r"\([^()]*\)(\?|\{[\d,]+\})?", " ", outside)):
            outside = less
        plain = re.findall(r"(?<!\S)[a-z0-9]+(?!\S)", outside)
        if not plain or "|" in outside:
            return " "
        return f" {max(plain, key=lambda w: (w not in COMMON, len(w)))} "

    @property
    def regex(self) -> str:
        def piece(m: re.Match) -> str:
            token = m.group()
            if token == "(":
                return "(?:"
            if token in ")|?" or token.startswith("{"):
                return token
            return "" if token.isspace() else f"(?: {token} )"

        return re.sub(r"\{[\d,]+\}|[^\s()|?{}]+|[()|?]|\s+", piece, self.pattern)


#: The phrases that always count, by label.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# label, identifier in a tag, title (with its version, or one that no other license has)
_LICENSES = """
gpl-1.0 | gpl 1 0( only| or later)? | gnu (general public license|gpl) (version|v) 1( 0)?
gpl-2.0 | gpl 2 0( only| or later)? | gnu (general public license|gpl) (version 2|v2|v 2)( 0)?
gpl-3.0 | gpl 3 0( only| or later)? | gnu (general public license|gpl) (version 3|v3|v 3)( 0)?
gpl-2.0 | gplv2 | gplv2( license)
gpl-3.0 | gplv3 | gplv3( license)
lgpl-2.0 | lgpl 2 0( only| or later)? | gnu library general public license (version 2|v2)( 0)?
lgpl-2.1 | lgpl 2 1( only| or later)? | gnu lesser general public license (version 2 1|v2 1)
lgpl-3.0 | lgpl 3 0( only| or later)? | gnu lesser general public license (version 3|v3)( 0)?
agpl-3.0 | agpl 3 0( only| or later)? | gnu affero general public license (version 3|v3)( 0)?
gfdl-1.3 | gfdl 1 3( only| or later)? | gnu free documentation license (version 1 3|v1 3)
gfdl-1.2 | gfdl 1 2( only| or later)? | gnu free documentation license (version 1 2|v1 2)
apache-1.1 | apache 1 1 | apache (software )?license (version 1 1|v1 1|1 1)
apache-2.0 | apache 2 0 | apache (software )?license (version 2|v2|2)( 0)?
mpl-1.1 | mpl 1 1 | mozilla public license (version 1 1|v1 1|1 1)
mpl-2.0 | mpl 2 0 | mozilla public license (version 2|v2|2)( 0)?
epl-1.0 | epl 1 0 | eclipse public license (version 1|v1|v 1|1)( 0)?
epl-2.0 | epl 2 0 | eclipse public license (version 2|v2|v 2|2)( 0)?
eupl-1.2 | eupl 1 2 | european union public licen[cs]e (version 1 2|v1 2|v 1 2|1 2)
cddl-1.0 | cddl 1 0 | common development and distribution license (version 1|v1|1)( 0)?
cpl-1.0 | cpl 1 0 | common public license (version 1|v1|1)( 0)?
osl-3.0 | osl 3 0 | open software license (version 3|v3|v 3|3)( 0)?
afl-3.0 | afl 3 0 | academic free license (version 3|v3|v 3|3)( 0)?
artistic-2.0 | artistic 2 0 | artistic license (version 2|v2|2)( 0)?
artistic-1.0 | artistic 1 0 | artistic license (version 1|v1|1)( 0)?
bsl-1.0 | bsl 1 0 | boost software license (version 1|v1|1)( 0)?
zpl-2.1 | zpl 2 1 | zope public license (version 2 1|v2 1|2 1)
psf-2.0 | psf 2 0 | python software foundation license (version 2|v2|2)( 0)?
php-3.01 | php 3 01 | php license (version 3 01|v3 01|3 01)
ofl-1.1 | ofl 1 1 | sil open font license (version 1 1|v1 1|1 1)
ecl-2.0 | ecl 2 0 | educational community license (version 2|v2|2)( 0)?
ms-pl | ms pl | microsoft public license
ms-rl | ms rl | microsoft reciprocal license
lppl-1.3c | lppl 1 3c | latex project public license (version 1 3c|v1 3c|1 3c)
cecill-2.1 | cecill 2 1 | cecill (free software )?license( agreement)? (version 2 1|v2 1|2 1)
bsd-2-clause | bsd 2 clause | simplified bsd license
bsd-2-clause | bsd 2 clause freebsd | freebsd license
bsd-2-clause | bsd 2 clause license | (bsd 2|2|two) clause( bsd)? license
bsd-3-clause | bsd 3 clause | (new|modified|revised) bsd license
bsd-3-clause | bsd 3 clause license | (bsd 3|3|three) clause( bsd)? license
bsd-4-clause | bsd 4 clause | original bsd license
bsd-4-clause | bsd 4 clause license | (bsd 4|4|four) clause( bsd)? license
0bsd | 0bsd | 0bsd license
0bsd | 0bsd license | zero clause bsd license
mit-0 | mit 0 | mit no attribution license
mit | mit | mit license
isc | isc | isc license
zlib | zlib | zlib( libpng)? license
x11 | x11 | x11 license
ncsa | ncsa | university of illinois( ncsa)? open source license
unlicense | unlicense | unlicense
wtfpl | wtfpl | wtfpl( license)?
postgresql | postgresql | postgresql licen[cs]e
ruby | ruby | ruby license
openssl | openssl | openssl license
vim | vim | vim license
curl | curl | curl license
icu | icu | icu license
json | json | json license
cc0-1.0 | cc0 1 0 | cc0( 1 0)?( universal)?
cc0-1.0 | cc0 1 0 universal | creative commons zero( v1 0| 1 0)?( universal)?
cc-by-4.0 | cc by 4 0 | cc by( license)? 4 0( international)?( license)?
cc-by-4.0 | cc by 4 0 international | creative commons attribution 4 0( international)?( public license| license)?
cc-by-3.0 | cc by 3 0 | cc by( license)? 3 0( unported)?( license)?
cc-by-3.0 | cc by 3 0 unported | creative commons attribution 3 0( unported)?( license)?
cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0
cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0
cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0
cc-by-nc-3.0 | cc by nc 3 0 | cc by nc 3 0
cc-by-nd-4.0 | cc by nd 4 0 | cc by nd 4 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0
cc-by-sa-4.0 | cc by sa 4 0 international | creative commons attribution (sharealike|share alike) 4 0( international)?( license)?
cc-by-nc-4.0 | cc by nc 4 0 international | creative commons attribution (noncommercial|non commercial) 4 0( international)?( license)?
odbl-1.0 | odbl 1 0 | open (data commons open )?database license (version 1|v1|1)( 0)?
odc-by-1.0 | odc by 1 0 | odc attribution license
cdla-permissive-2.0 | cdla permissive 2 0 | community data license agreement permissive (version )?2 0
bigcode-openrail-m | bigcode openrail m | bigcode openrail m( v1)?( license)?
openrail | openrail | openrail license
"""

# label, titles of families without a version
_TITLES = """
gpl | gnu general public license
gpl | (gnu )?gpl( license)
apache | apache( software)? license
cc-by | cc by( license)?
cc-by | creative commons attribution( license)?
lgpl | gnu (lesser|library) general public license
lgpl | (gnu )?lgpl( license)
agpl | (gnu )?affero general public license
agpl | (gnu )?agpl( license)
gfdl | gnu free documentation license
mpl | mozilla public license
epl | eclipse public license
bsd | bsd( style)? licen[cs]e
mit | expat license
artistic | artistic license
boost | boost software license
ofl | open font license
cc-by-sa | cc by sa
cc-by-nc | cc by nc
cc-by-nd | cc by nd
cc-by-nc-sa | cc by nc sa
cc-by-nc-nd | cc by nc nd
cc | creative commons( public)? license
public-domain | the public domain
"""

# label, words of a license's own text
_TEXTS = """
mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
isc | permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-3-clause | neither the name of( the)? \\S+{1,6} nor the names of its contributors may be used to endorse or promote
bsd-4-clause | all advertising materials mentioning features or use of this software must display( the following \\S+)?
apache-2.0 | licensed under the apache license version 2 0 the license
apache-2.0 | www apache org licenses license 2 0
gpl | you can redistribute it and or modify it under the terms of the gnu general public license
gpl-2.0 | gnu general public license as published by the free software foundation either version 2( of the license)?
gpl-3.0 | gnu general public license as published by the free software foundation either version 3( of the license)?
gpl-2.0 | gnu general public license (as published by the free software foundation )?version 2 only
lgpl-2.1 | gnu lesser general public license as published by the free software foundation either version 2 1( of the license)?
lgpl-3.0 | gnu lesser general public license as published by the free software foundation either version 3( of the license)?
agpl-3.0 | gnu affero general public license as published by the free software foundation either version 3( of the license)?
gpl | www gnu org licenses( gpl( \\S+){0,2})
lgpl | www gnu org licenses lgpl( \\S+)?
agpl | www gnu org licenses agpl( \\S+)?
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | if a copy of the mpl was not distributed with this file you can obtain one at (http |https )?mozilla org( mpl 2 0)?
mit | opensource org (license|licenses) mit( license)?
bsd-3-clause | opensource org (license|licenses) bsd 3 clause
bsd-2-clause | opensource org (license|licenses) bsd 2 clause
cc-by-4.0 | creativecommons org licenses by 4 0
cc-by-sa-4.0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons org licenses by nc 4 0
cc-by-nd-4.0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-4.0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons org licenses by nc nd 4 0
cc0-1.0 | creativecommons org publicdomain zero( license)? 1 0
zlib | the origin of this software must not be misrepresented( you must not claim license)?
unlicense | this is free and unencumbered software released into the public domain
wtfpl | do what the (fuck|f) you want to public license
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
ofl-1.1 | this font software is licensed under the sil open font license( version 1 1)?
public-domain | dedicated to the public domain
public-domain | no copyright( and related rights)? (is )?claimed
epl-2.0 | made available under the terms of the eclipse public license (v 2 0|2 0)
cc-by | licensed under a creative commons attribution( \\S+){0,3} license
proprietary | copyright( \\S+){1,6} all rights reserved
proprietary | confidential and proprietary license
"""

# label, sentences that name no license of the list
_HINTS = """
unknown | (licensed|released|distributed|available|published) under( \\S+){1,6} licen[cs]e
unknown | under the terms of( \\S+){1,6} licen[cs]e
unknown | governed by( \\S+){1,6} licen[cs]e
unknown | see the license file
unknown | license agreement
unknown | copyright (c )?(19\\d\\d|20\\d\\d)
"""


def _lines(block: str) -> list[list[str]]:
    """Fields of each line; a field may hold alternatives without spaces around the bar."""
    return [line.split(" | ") for line in block.strip().splitlines()]


def signatures() -> list[Signature]:
    """All rules in order: per license its tag, its statements and its title, then texts,
    titles of families and hints."""
    rules = []
    for label, tag, title in _lines(_LICENSES):
        rules.append(Signature(label, "tag", f"spdx license identifier {tag}", 1))
        named = f"({title})" if re.search(r"\|(?![^(]*\))", title) else title
        rules.append(Signature(label, "statement", f"under( the)? {named}", 1))
        if "licen" in title or "cc" in title:
            rules.append(Signature(label, "title", title, 1))
    rules += [Signature(label, "text", words, 1) for label, words in _lines(_TEXTS)]
    rules += [Signature(label, "title", words, 2) for label, words in _lines(_TITLES)]
    rules += [Signature(label, "hint", words, 3) for label, words in _lines(_HINTS)]
    return rules


def _word_spans(norm: Column, regex: Column) -> Column:
    """(start, words) of each match of a regular expression, in the order of the text."""

    def count(part: Column) -> Column:
        # each word has a space on either side
        return ((F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))) / 2).cast("int")

    empty = F.expr("array_repeat(named_struct('start', 0, 'size', 0), 0)")
    gaps = F.transform(F.split(norm, regex, -1), count)
    sizes = F.transform(F.regexp_extract_all(norm, regex, F.lit(0)), count)
    # running sums in pieces, so that a text with very many matches stays linear
    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("array_repeat(array_repeat(named_struct('start', 0, 'size', 0), 0), 0)").alias("full"),
        empty.alias("open"),
    )

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        span = F.array(F.struct(begin.alias("start"), x["size"].alias("size")))
        return _appended(acc, span).withField("at", begin + x["size"])

    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(sizes)), sizes,
        lambda g, s: F.struct(g.alias("gap"), s.alias("size")),
    )
    return F.aggregate(pairs, start, step, _all_parts)


#: Spans gathered in one array before it is put aside.
_PART = 256


def _appended(acc: Column, span: Column) -> Column:
    """The state with one more span; full parts are put aside, so that nothing long is
    copied for every span."""
    more = F.concat(acc["open"], span)
    full = F.size(more) >= _PART
    return acc.withField(
        "full", F.when(full, F.concat(acc["full"], F.array(more))).otherwise(acc["full"])
    ).withField("open", F.when(full, F.slice(more, 1, 0)).otherwise(more))


def _all_parts(acc: Column) -> Column:
    return F.concat(F.flatten(acc["full"]), acc["open"])


_SPAN = "struct<start:int,stop:int,rule:int,priority:int>"
#: Internal columns; input columns are not named so.
_NORM, _N, _BASE, _SPANS = (f"__license_{x}" for x in ("norm", "n", "base", "spans"))


def _kept(found: Column) -> Column:
    """The detections that stand, from all of them (start, stop, rule, priority)."""
    ordered = F.transform(
        F.array_sort(
            F.transform(
                found,
                lambda x: F.struct(
                    x["start"].alias("start"), (-x["stop"]).alias("back"),
                    x["rule"].alias("rule"), x["priority"].alias("priority"),
                ),
            )
        ),
        lambda x: F.struct(
            x["start"].alias("start"), (-x["back"]).alias("stop"),
            x["rule"].alias("rule"), x["priority"].alias("priority"),
        ),
    )
    start = F.struct(
        F.lit(None).cast(_SPAN).alias("last"),
        F.array().cast(f"array<array<{_SPAN}>>").alias("full"),
        F.array().cast(f"array<{_SPAN}>").alias("open"),
    )

    def step(acc: Column, x: Column) -> Column:
        last = acc["last"]
        better = x["priority"] < last["priority"]
        overlaps = x["start"] < last["stop"]
        stays = overlaps & ~better & (
            (x["stop"] <= last["stop"]) | (x["priority"] > last["priority"])
        )
        none = F.slice(acc["open"], 1, 0)
        out = F.when(last.isNull() | (overlaps & better) | stays, none).otherwise(F.array(last))
        grown = _appended(acc, out)
        return F.struct(
            F.when(F.coalesce(stays, F.lit(False)), last).otherwise(x).alias("last"),
            grown["full"].alias("full"),
            grown["open"].alias("open"),
        )

    def end(acc: Column) -> Column:
        none = F.slice(acc["open"], 1, 0)
        return F.concat(
            _all_parts(acc), F.when(acc["last"].isNull(), none).otherwise(F.array(acc["last"]))
        )

    return F.aggregate(ordered, start, step, end)


def _rule_table(rules: list[Signature]) -> Column:
    """The rules by keyword."""
    by_keyword: dict[str, list[Column]] = {}
    for i, r in enumerate(rules):
        by_keyword.setdefault(r.keyword, []).append(
            F.struct(
                F.lit(i).alias("rule"), F.lit(r.priority).alias("priority"),
                F.lit(r.regex).alias("regex"),
            )
        )
    return F.array(
        *[
            F.struct(F.lit(word).alias("keyword"), F.array(*own).alias("rules"))
            for word, own in by_keyword.items()
        ]
    )


def scan_licenses(
    docs: DataFrame, rules: list[Signature] | None = None, text_col: str = "text"
) -> DataFrame:
    """docs with `_scan`: `n_words`, `base` (label, start, stop: every place of a base
    phrase) and `found` (label, kind, start, stop: the detections that stand), in words."""
    rules = signatures() if rules is None else rules
    own = docs.columns
    # words part at ASCII only, so that lower-casing other letters too changes no word's place
    bare = F.regexp_replace(F.lower(F.coalesce(text_col, F.lit(""))), SEPARATORS, " ")
    step = docs.select(*own, F.concat(F.lit(" "), F.trim(bare), F.lit(" ")).alias(_NORM))
    text = F.col(_NORM)
    gaps = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    n_words = F.when(text == "  ", 0).otherwise(gaps - 1).cast("bigint")
    gate = reduce(or_, [text.rlike(stem) for stem in STEMS])
    # a space on either side of each word
    spaced = F.concat(F.lit(" "), F.replace(F.trim(text), F.lit(" "), F.lit("  ")), F.lit(" "))
    step = step.select(*own, n_words.alias(_N), F.when(gate, spaced).alias(_NORM))

    base_table = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(Signature(label, "", phrase, 1).regex).alias("regex"),
            )
            for label, phrase in BASE
        ]
    )
    base = F.flatten(
        F.transform(
            base_table,
            lambda b: F.transform(
                _word_spans(F.col(_NORM), b["regex"]),
                lambda s: F.struct(
                    b["label"].alias("label"), s["start"].alias("start"),
                    (s["start"] + s["size"]).alias("stop"),
                ),
            ),
        )
    )
    hinted = F.filter(_rule_table(rules), lambda r: F.contains(F.col(_NORM), r["keyword"]))
    gated = F.flatten(F.transform(hinted, lambda r: r["rules"]))
    spans = F.flatten(
        F.transform(
            F.filter(gated, lambda r: F.rlike(F.col(_NORM), r["regex"])),
            lambda r: F.transform(
                _word_spans(F.col(_NORM), r["regex"]),
                lambda s: F.struct(
                    s["start"].alias("start"), (s["start"] + s["size"]).alias("stop"),
                    r["rule"].alias("rule"), r["priority"].alias("priority"),
                ),
            ),
        )
    )
    seen = F.col(_NORM).isNotNull()
    step = step.select(
        *own, _N, F.when(seen, base).alias(_BASE), F.when(seen, spans).alias(_SPANS)
    )
    kept = F.when(F.size(_SPANS) > 0, _kept(F.col(_SPANS)))
    step = step.select(*own, _N, _BASE, kept.alias(_SPANS))
    names = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.kind).alias("kind")) for r in rules])
    found = F.transform(
        F.col(_SPANS),
        lambda x: F.struct(
            F.get(names, x["rule"])["label"].alias("label"),
            F.get(names, x["rule"])["kind"].alias("kind"),
            x["start"].alias("start"), x["stop"].alias("stop"),
        ),
    )
    place = "start:int,stop:int"
    no_base = F.array().cast(f"array<struct<label:string,{place}>>")
    none = F.array().cast(f"array<struct<label:string,kind:string,{place}>>")
    scan = F.struct(
        F.col(_N).alias("n_words"),
        F.coalesce(_BASE, no_base).alias("base"),
        F.coalesce(found, none).alias("found"),
    )
    return step.select(*[c for c in own if c != "_scan"], scan.alias("_scan"))


def license_report(docs: DataFrame, rules: list[Signature] | None = None) -> DataFrame:
    """`doc_id`, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`,
    `score` (the weight of the strongest detection) and `n_found` for each row of docs."""
    rows = scan_licenses(docs.select("doc_id", "text"), rules)
    base, found = F.col("_scan.base"), F.col("_scan.found")
    starts = F.transform(base, lambda b: b["start"].cast("bigint"))

    def names(spans: Column) -> Column:
        return F.transform(spans, lambda s: s["label"])

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    weights = F.transform(
        F.array_distinct(F.transform(found, lambda x: x["kind"])),
        lambda k: F.element_at(
            F.create_map(*[F.lit(v) for pair in WEIGHTS.items() for v in pair]), k
        ),
    )
    return rows.select(
        "doc_id",
        F.col("_scan.n_words").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(names(base)).alias("base_labels"),
        joined(F.concat(names(base), names(found))).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.size(found).cast("bigint").alias("n_found"),
    )
