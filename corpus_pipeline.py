"""A corpus pipeline: documents in, a training schedule out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but
the last return the columns of documents; the last adds the schedule's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.decontaminate import drop_contaminated
from roadpulse.llm.frames import discard, stage, table
from roadpulse.llm.lpf_dedup import drop_repeats
from roadpulse.llm.mixing import schedule
from roadpulse.llm.quality_rules import drop_poor
from roadpulse.llm.registry import MIXING
from roadpulse.llm.simhash import drop_near_copies


#: Bytes of a string that counts as a repeated passage. Of the passages of 50 words in the check
#: tool's documents (40,423 measured) 99 % are longer: quantiles 0.001, 0.01, 0.05, 0.5 are
#: 149, 246, 269 and 309 bytes.
REPEAT_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return drop_poor(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return drop_near_copies(docs, shingle=4, max_bits=4)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of long strings go from the texts; their first occurrence stays."""
    return drop_repeats(docs, length=REPEAT_BYTES, keep="first")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source at its weight: a row for each time that a document is taken."""
    return schedule(docs, MIXING)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
]

#: Suffix arrays and SimHash groups are beyond SQL on whole tables; tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
