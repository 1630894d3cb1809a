"""The registered queries of this package and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .decontaminate import contamination
from .frames import table
from .hard_negatives import hard_negatives
from .lexical_search import ranked_documents
from .license_rules import license_report
from .lpf_dedup import removal_report
from .lm_filter import score_documents
from .mixing import Target, schedule
from .quality_model import score_quality
from .quality_rules import judge_quality
from .simhash import simhash_groups
from .toxicity import score_toxicity
from .url_rules import Rule, judge_urls
from .window_dedup import window_report


#: The longest rule that fits decides.
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
#: The source mix: no source is left out, none passes more than twice.
MIXING = Target(max_repeats=2.0)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"), length=400, keep="none")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return schedule(docs, MIXING).drop("text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_report(table(spark, sf_dir, "documents"), size=50).drop("kept_text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label, F.col("id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_benchmark_decontamination": op2_benchmark_decontamination,
        "op3_simhash_near_dedup": op3_simhash_near_dedup,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_mixing": op5_mixing,
        "op6_toxicity": op6_toxicity,
        "op7_url_filters": op7_url_filters,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_quality_rules": op9_quality_rules,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_license_scan": op12_license_scan,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_benchmark_decontamination": sql.contamination(),
        "op5_mixing": sql.mixing(max_repeats=MIXING.max_repeats),
        "op7_url_filters": sql.url_filters(URL_RULES),
        "op9_quality_rules": sql.quality_rules(),
        "op11_hard_negatives": sql.hard_negatives(),
        "op12_license_scan": sql.license_scan(),
        "op13_lexical_search": sql.lexical_search(),
    }
