"""DuckDB statements for the queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_rules import BASE, SEPARATORS, WEIGHTS, Signature, signatures
from .quality_rules import (
    CLASS_SHARES,
    CLASSES,
    COMMON_LETTERS,
    HANGING,
    SYMBOLS,
    WORD_SHARES,
    Limits,
)
from .url_rules import HOST_GLOBS, Rule


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _by_lang(values: dict[str, list], literal) -> str:
    arms = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(map(literal, own))}]" for lang, own in values.items()
    )
    return f"CASE lang_used {arms} END"


def quality_rules() -> str:
    limits = Limits()
    langs = list(WORD_SHARES)
    rare = " ".join(
        f", len(rare) - len(regexp_replace(rare, {_text(p)}, '', 'g')) AS class_{i}"
        for i, p in enumerate(CLASSES)
    )
    classes = [f"class_{i}" for i in range(len(CLASSES))]
    hits = {x: f"len(list_filter(bare, lambda w: w IN ({', '.join(map(_text, WORD_SHARES[x]))})))"
            for x in langs}
    guess = " ".join(
        f"WHEN {hits[x]} = greatest({', '.join(hits.values())}) THEN '{x}'" for x in langs
    )
    words = {x: list(s) for x, s in WORD_SHARES.items()}
    word_shares = {x: [*s.values(), 1 - sum(s.values())] for x, s in WORD_SHARES.items()}

    def distance(counts: str, total: str, shares: str) -> str:
        pairs = f"list_zip(list_transform({counts}, lambda x: x / {total}), {shares})"
        term = (
            "CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END"
            " + z[2] * log2(2 * z[2] / (z[1] + z[2]))"
        )
        return f"sqrt(greatest(list_sum(list_transform({pairs}, lambda z: {term})) / 2, 0))"

    return f"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)),
      lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
    len(text) AS chars, regexp_replace(text, '{COMMON_LETTERS}+', '', 'g') AS rare
  FROM given
), spans AS (
  SELECT r, unnest(list_transform(range(1, len(words) - 3),
    lambda i: {{'w': array_to_string(words[i:i+4], ' '), 'i': i}}), recursive := true)
  FROM parts WHERE len(words) > 4
), starts AS (
  SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM spans) WHERE n > 1
), repeated AS (
  SELECT r, sum(least(5, coalesce(i - before, 5))) AS n_repeat_words FROM starts GROUP BY r
), bare AS (
  SELECT *, list_transform(words, lambda w: rtrim(lower(w), {_text(HANGING)})) AS bare
  FROM parts
), counted AS (
  SELECT *, CASE WHEN lang IN ({', '.join(map(_text, langs))}) THEN lang ELSE
    CASE {guess} END END AS lang_used, len(words) AS n {rare}
  FROM bare
), common AS (
  SELECT *, list_transform({_by_lang(words, _text)},
    lambda c: len(list_filter(bare, lambda w: w = c))) AS common
  FROM counted
), judged AS (
  SELECT r, doc_id, n AS n_words, chars - class_0 AS word_chars,
    len(rare) - len(translate(rare, {_text(SYMBOLS)}, '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    CASE WHEN chars >= {limits.min_chars} THEN {distance(
        f"[{', '.join(classes)}, chars - {' - '.join(classes)}]", "chars",
        _by_lang(CLASS_SHARES, repr))} ELSE 0 END AS class_distance,
    CASE WHEN n >= {limits.min_words} THEN {distance(
        "list_append(common, n - list_sum(common))", "n",
        _by_lang(word_shares, repr))} ELSE 0 END AS word_distance
  FROM common
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * n_words)
    AND class_distance <= {limits.max_class_distance}
    AND word_distance <= {limits.max_word_distance} AS kept
FROM judged LEFT JOIN repeated USING (r)
"""


LOWER = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "regexp_extract_all(%s, '[^\\x20\\x09-\\x0D]+')"


def contamination(size: int = 5, threshold: float = 0.8) -> str:
    def worded(name: str, row_id: str) -> str:
        return f"SELECT {row_id}, {WORDS % (LOWER % "coalesce(text, '')")} AS w FROM {name}"

    runs = "list_transform(range(1, len(w) - width + 2), lambda i: " \
        "array_to_string(w[i:i+width-1], ' '))"  # fmt: skip
    return f"""
WITH sized AS (
  SELECT *, least(len(w), {size}) AS width FROM ({worded("benchmark", "item_id")}) WHERE len(w) > 0
), items AS (SELECT DISTINCT item_id, unnest({runs}) AS s FROM sized),
docs AS (
  SELECT DISTINCT doc_id, unnest({runs}) AS s
  FROM ({worded("documents", "doc_id")}), (SELECT DISTINCT width FROM sized)
),
sizes AS (SELECT item_id, count(*) AS n_shingles FROM items GROUP BY item_id)
SELECT doc_id, item_id, n_shingles::INTEGER AS n_shingles, count(*)::INTEGER AS n_common
FROM docs JOIN items USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= {threshold} * n_shingles - 1e-9
"""


def mixing(max_repeats: float, block_docs: int = 1024, seed: int = 7) -> str:
    """With the exponent in closed form: passes of the smallest source over passes of the
    largest are the ratio of their tokens to the power of one less the exponent."""
    words = WORDS % "coalesce(text, '')"
    return f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(source, '') AS src, len({words})::BIGINT AS n_tokens,
    md5(concat_ws(':', {seed}, coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS ord
  FROM documents
), counts AS (
  SELECT src, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM sized GROUP BY src
), fit AS (
  SELECT max(tokens)::DOUBLE AS most, CASE WHEN max(tokens) <= {max_repeats} * min(tokens) THEN 0
    ELSE 1 - ln({max_repeats}) / ln(max(tokens) / min(tokens)::DOUBLE) END AS a
  FROM counts WHERE tokens > 0
), quotas AS (
  SELECT src, ceil(docs / {block_docs}.0)::BIGINT AS blocks, greatest(tokens, 1) AS pass,
    CASE WHEN tokens = 0 THEN 1
      ELSE round(most * (tokens / most) ** a)::BIGINT END AS quota
  FROM counts, fit
), dealt AS (
  SELECT sized.*, pass, quota, ('0x' || substr(ord, 1, 8))::BIGINT % blocks AS b
  FROM sized JOIN quotas USING (src)
), epochs AS (
  SELECT src, b, pass, quota, sum(n_tokens)::BIGINT AS tokens,
    unnest(range(0, ((quota + pass - 1) // pass))) AS epoch
  FROM dealt GROUP BY src, b, pass, quota
), plan AS (
  SELECT *, row_number() OVER w - 1 AS block, sum(tokens) OVER w - tokens AS before
  FROM epochs
  WINDOW w AS (PARTITION BY src, epoch
               ORDER BY md5(concat_ws(':', {seed}, src, epoch, b)), b)
), taken AS (
  SELECT doc_id, source, n_tokens, epoch, block, before, (epoch + 1) * plan.pass <= plan.quota AS whole,
    plan.quota - epoch * plan.pass - before AS left_over,
    sum(n_tokens) OVER (PARTITION BY src, b, epoch ORDER BY ord
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
  FROM dealt JOIN plan USING (src, b)
)
SELECT doc_id, source, n_tokens, epoch::INTEGER AS epoch, block::INTEGER AS block FROM taken
WHERE whole OR (left_over > 0 AND so_far <= left_over)
"""


def url_filters(rules: list[Rule], host_globs: tuple[str, ...] = HOST_GLOBS) -> str:
    ranked = sorted(rules, key=lambda r: -len(r.name))

    def arms(value) -> str:
        return " ".join(
            f"WHEN (host = {_text(r.host)} OR ends_with(host, {_text('.' + r.host)}))"
            f" AND starts_with(path, {_text(r.path)}) THEN {_text(value(r))}"
            for r in ranked
        )

    globs = " OR ".join(f"host LIKE {_text(g.replace('*', '%'))}" for g in host_globs)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), raw AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM cut
), parts AS (
  SELECT page_id, {LOWER % "host"} AS host,
    regexp_extract(substr(rest, len(host) + 1), '^[^?#]*') AS path
  FROM raw
)
SELECT page_id, host, path, CASE {arms(lambda r: r.name)} END AS rule,
  CASE {arms(lambda r: r.verdict)} WHEN {globs} THEN 'block' ELSE 'allow' END AS verdict
FROM parts
"""


def license_scan() -> str:
    rules = ", ".join(
        f"({i}, {_text(s.label)}, {WEIGHTS[s.kind]}, {s.priority}, {_text(s.regex)})"
        for i, s in enumerate(signatures())
    )
    base = ", ".join(
        f"({-1 - i}, {_text(label)}, 0.0, 0, {_text(Signature(label, '', phrase, 1).regex)})"
        for i, (label, phrase) in enumerate(BASE)
    )
    size = "((len(%s) - len(replace(%s, ' ', ''))) // 2)"
    return f"""
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, doc_id, ' ' || trim(regexp_replace(
    lower(coalesce(text, '')), {_text(SEPARATORS)}, '  ', 'g')) || ' ' AS t FROM documents
), rules(rule, label, weight, priority, regex) AS (VALUES {rules}, {base}
), hits AS (
  SELECT r, rule, priority, list_transform(regexp_extract_all(t, regex), lambda x:
      {size % ('x', 'x')}) AS m,
    list_transform(string_split_regex(t, regex), lambda x: {size % ('x', 'x')}) AS g
  FROM given, rules WHERE regexp_matches(t, regex)
), numbered AS (
  SELECT r, rule, priority, m, g, unnest(range(1, len(m) + 1)) AS i FROM hits
), spans AS (
  SELECT r, rule, priority, list_sum(g[1:i]) + coalesce(list_sum(m[1:i - 1]), 0) AS start,
    m[i] AS size FROM numbered
), ordered AS (
  SELECT r, rule, priority, start, start + size AS stop,
    row_number() OVER (PARTITION BY r ORDER BY start, size DESC, rule) AS n
  FROM spans WHERE rule >= 0
), sweep AS (
  SELECT r, n, start, stop, rule, priority, NULL::INTEGER AS out FROM ordered WHERE n = 1
  UNION ALL
  SELECT r, n, if(stays, a_start, b_start), if(stays, a_stop, b_stop), if(stays, a_rule, b_rule),
    if(stays, a_priority, b_priority), if(stays OR (touch AND better), NULL, a_rule)
  FROM (SELECT b.r, b.n, a.start AS a_start, a.stop AS a_stop, a.rule AS a_rule,
      a.priority AS a_priority, b.start AS b_start, b.stop AS b_stop, b.rule AS b_rule,
      b.priority AS b_priority, b.priority < a.priority AS better, b.start < a.stop AS touch,
      b.start < a.stop AND b.priority >= a.priority
        AND (b.stop <= a.stop OR b.priority > a.priority) AS stays
    FROM sweep a JOIN ordered b ON a.r = b.r AND b.n = a.n + 1)
), kept AS (
  SELECT r, out AS rule FROM sweep WHERE out IS NOT NULL
  UNION ALL
  SELECT r, rule FROM sweep WHERE (r, n) IN (SELECT (r, max(n)) FROM ordered GROUP BY r)
), found AS (
  SELECT r, list(label) AS labels, max(weight)::DOUBLE AS score, count(*) AS n_found
  FROM kept JOIN rules USING (rule) GROUP BY r
), base AS (
  SELECT r, list(label) AS labels, count(*) AS n_base, min(start) AS first_word,
    max(start) AS last_word
  FROM spans JOIN rules USING (rule) WHERE rule < 0 GROUP BY r
)
SELECT doc_id, (CASE WHEN t = '  ' THEN 0 ELSE {size % ('t', 't')} END)::BIGINT AS n_words,
  coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  coalesce(score, 0) AS score, coalesce(n_found, 0)::BIGINT AS n_found
FROM given LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""


def lexical_search(k: int = 50) -> str:
    terms = "regexp_extract_all(%s, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    own = terms % (LOWER % "coalesce(text, '')")
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS r, doc_id, {own} AS words FROM documents
), sizes AS (
  SELECT r, doc_id, len(words)::BIGINT AS n FROM given WHERE len(words) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes
), tf AS (
  SELECT r, word, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS word FROM given)
  GROUP BY r, word
), weights AS (
  SELECT word, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT word, count(*)::BIGINT AS df FROM tf GROUP BY word), corpus
), items AS (
  SELECT DISTINCT item_id, text, unnest({own}) AS word FROM benchmark
), scores AS (
  SELECT item_id, text, doc_id, r, sum(w * ((1000000000 * tf) //
    (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM items JOIN tf USING (word) JOIN weights USING (word) JOIN sizes USING (r), corpus
  GROUP BY item_id, text, doc_id, r
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text
    ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {k}
"""


def hard_negatives() -> str:
    return """
WITH good AS (
  SELECT row_number() OVER () AS r, * FROM (SELECT DISTINCT vec_id,
      CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), scored AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.r <> b.r
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS FIRST) AS p
  FROM scored WHERE same QUALIFY p <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER (
    PARTITION BY p.r, p.p ORDER BY n.score DESC, n.vec_id NULLS FIRST))::INTEGER AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.r = p.r AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
