"""Quality rules from distribution divergence, in built-in functions only.

A document is compared with its language by two histograms: the classes of its
characters, and its common words. Each is measured by the Jensen-Shannon distance
(base 2, 0 to 1); short documents are not judged by a histogram they cannot fill.

Defined results: a null or empty text has no words and fails the base rule; a null or
unknown `lang` takes the language with most common words in the text (the first one on
ties); equal rows are judged alike; extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import SPACE_CLASS, words

#: Shares of (space, upper case, digits, punctuation, symbols, other
#: characters) in prose, and the shares of the commonest words of each language.
CLASS_SHARES = {
    "en": (0.165, 0.025, 0.003, 0.035, 0.001, 0.771),
    "de": (0.150, 0.030, 0.003, 0.035, 0.001, 0.781),
    "fr": (0.165, 0.025, 0.003, 0.035, 0.001, 0.771),
    "es": (0.165, 0.025, 0.003, 0.035, 0.001, 0.771),
}
WORD_SHARES = {
    "en": {"the": 0.062, "of": 0.036, "and": 0.026, "to": 0.020, "a": 0.017, "in": 0.014,
           "is": 0.012, "that": 0.011, "it": 0.009, "for": 0.009, "was": 0.008, "on": 0.007},
    "de": {"der": 0.061, "die": 0.036, "und": 0.026, "in": 0.020, "den": 0.016, "von": 0.014,
           "zu": 0.012, "das": 0.010, "mit": 0.009, "sich": 0.008, "des": 0.008, "auf": 0.007},
    "fr": {"de": 0.062, "la": 0.036, "le": 0.026, "et": 0.020, "les": 0.016, "des": 0.014,
           "en": 0.012, "un": 0.010, "du": 0.009, "une": 0.008, "que": 0.008, "est": 0.007},
    "es": {"de": 0.061, "la": 0.036, "que": 0.025, "el": 0.019, "en": 0.016, "y": 0.013,
           "los": 0.012, "se": 0.011, "del": 0.009, "un": 0.008, "las": 0.008, "por": 0.007},
}
#: Character classes by pattern, in the order of CLASS_SHARES; the rest is the last one.
CLASSES = (
    f"[{SPACE_CLASS}]",
    r"\p{Lu}",
    "[0-9]",
    r"""[.,;:!?'"()\-]""",
    r"[#*$%&|<>@^~_=+{}\[\]\\/`]",
)
#: In none of these classes; dropped first, so that they scan little.
COMMON_LETTERS = "[a-zß-öø-ÿ]"
#: Marks that may hang on a common word.
HANGING = ".,;:!?"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A text with fewer characters or words than the guards is not judged by the
    histogram in question."""

    min_chars: int = 300
    max_class_distance: float = 0.21
    min_words: int = 60
    max_word_distance: float = 0.36


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "class_distance", "word_distance", "kept",
)


def _let(name: str, value: str, body: str) -> str:
    """SQL that binds a value once, so that lambdas do not compute it for each element."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


#: Words covered by five-word windows found twice or more, over the array `_words`.
#: Windows are compared by a 64-bit hash within one document. Only documents that have
#: such windows sort them.
_REPEATED = _let(
    "w",
    "_words",
    "CASE WHEN size(w) < 6 THEN 0L ELSE "
    + _let(
        "h",
        "transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4]))",
        "CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE "
        + _let(
            "s",
            "sort_array(transform(h, (x, i) -> struct(x AS h, i AS i)))",
            _let(
                "p",
                "sort_array(transform(filter(transform(s, (x, i) -> struct(x.i AS i, "
                "(i > 0 AND s[greatest(i - 1, 0)].h = x.h) OR "
                "(i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].h = x.h) AS twice)), "
                "x -> x.twice), x -> x.i))",
                "aggregate(transform(p, (x, i) -> CASE WHEN i = 0 THEN 5 "
                "ELSE least(5, x - p[greatest(i - 1, 0)]) END), 0L, (t, x) -> t + x)",
            ),
        )
        + " END",
    )
    + " END",
)


def _distance(counts: str, total: str, shares: str) -> Column:
    """Jensen-Shannon distance of an array of counts (what is missing from the total is
    the last class) from an array of shares."""
    p = f"concat({counts}, array({total} - aggregate({counts}, 0, (a, x) -> a + x)))"
    term = "CASE WHEN x > 0 THEN x * log2(2 * x / (x + q)) ELSE 0D END + q * log2(2 * q / (x + q))"
    terms = f"zip_with(transform({p}, x -> x / {total}), {shares}, (x, q) -> {term})"
    return F.expr(f"sqrt(greatest(aggregate({terms}, 0D, (a, x) -> a + x) / 2, 0D))")


def _array_by_lang(values: dict[str, list]) -> Column:
    """The array of the row's language."""
    picked = F.lit(None)
    for lang, own in values.items():
        picked = F.when(F.col("_lang") == lang, F.array(*map(F.lit, own))).otherwise(picked)
    return picked


def _count_in(hits: str, own: list[str]) -> Column:
    return F.size(F.filter(hits, lambda w: w.isin(own)))


def judge_quality(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """`doc_id`, counts, the two distances (null if not judged), `base_failed`, `kept`:
    one row for each row of docs, without a shuffle."""
    needed = [c for c in ("doc_id", "lang", "text") if c in docs.columns]
    return _judged(docs.select(needed), limits).select("_row.doc_id", *MEASURES)


def drop_poor(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """The rows of docs that are kept.

    The filter also reads a column that is not deterministic (and always true), so that
    Spark does not move it below the measures and compute them once for each mention."""
    judged = _judged(docs, limits).withColumn("_once", F.monotonically_increasing_id())
    return judged.filter("kept AND _once >= 0").select("_row.*")


def _judged(docs: DataFrame, limits: Limits | None) -> DataFrame:
    """`_row` (a row of docs) and its measures."""
    limits = limits or Limits()
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    text = F.col("text")
    langs = list(WORD_SHARES)
    common = sorted({w for shares in WORD_SHARES.values() for w in shares})
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    df = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        lang.alias("_given"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).select(
        "_row",
        "_given",
        words(text).alias("_words"),
        lines.alias("_lines"),
        F.char_length("text").alias("_chars"),
        F.regexp_replace(text, f"{COMMON_LETTERS}+", "").alias("_rare"),
    )
    longest = max(len(w.encode()) for w in common)
    hits = F.filter(
        F.transform(
            F.filter("_words", lambda w: F.octet_length(w) <= longest + 2),
            lambda w: F.rtrim(F.lower(w), F.lit(HANGING)),
        ),
        lambda w: w.isin(common),
    )
    per_lang = [_count_in("_hits", list(WORD_SHARES[x])) for x in langs]
    most = F.greatest(*per_lang)
    guessed = F.lit(langs[-1])
    for name, n in reversed(list(zip(langs[:-1], per_lang[:-1], strict=True))):
        guessed = F.when(n == most, name).otherwise(guessed)
    classes = [
        F.char_length("_rare") - F.char_length(F.regexp_replace("_rare", pattern, ""))
        for pattern in CLASSES
    ]
    df = (
        df.withColumn("_hits", hits)
        .withColumn(
            "_lang", F.when(F.col("_given").isin(langs), F.col("_given")).otherwise(guessed)
        )
        .select(
            "_row",
            "_lang",
            F.size("_words").cast("long").alias("n_words"),
            (F.col("_chars") - classes[0]).cast("long").alias("word_chars"),
            (F.char_length("_rare") - F.char_length(F.translate("_rare", SYMBOLS, "")))
            .cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines")))
            .cast("long").alias("n_dup_lines"),
            F.expr(_REPEATED).cast("long").alias("n_repeat_words"),
            "_chars",
            F.array(*classes).alias("_classes"),
            F.transform(
                _array_by_lang({x: list(WORD_SHARES[x]) for x in langs}),
                lambda c: F.size(F.filter("_hits", lambda h: h == c)),
            ).alias("_common"),
            _array_by_lang(CLASS_SHARES).alias("_class_shares"),
            _array_by_lang(
                {x: [*s.values(), 1 - sum(s.values())] for x, s in WORD_SHARES.items()}
            ).alias("_word_shares"),
        )
    )
    class_distance = F.when(
        F.col("_chars") >= limits.min_chars, _distance("_classes", "_chars", "_class_shares")
    )
    word_distance = F.when(
        F.col("n_words") >= limits.min_words,
        _distance("_common", "int(n_words)", "_word_shares"),
    )
    base_failed = (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")
    )
    return df.select(
        "_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        class_distance.alias("class_distance"),
        word_distance.alias("word_distance"),
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & (F.coalesce("class_distance", F.lit(0.0)) <= limits.max_class_distance)
        & (F.coalesce("word_distance", F.lit(0.0)) <= limits.max_word_distance),
    )
