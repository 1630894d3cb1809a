"""Duplicate ranking by event id, safe when one id covers much of the data.

All NULL ids count as one id. Equal timestamps are decided by the remaining
columns in order, so only fully identical rows are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _earliest_first(df: DataFrame, key: str, moment: str) -> list:
    rest = [c for c in df.columns if c not in (key, moment)]
    return [F.col(c).asc_nulls_last() for c in [moment, *rest]]


def first_copies(df: DataFrame, key: str, moment: str) -> DataFrame:
    """One row per ``key``: the earliest.

    Filtering on rank 1 directly lets Spark drop later copies in every map task
    before the shuffle (WindowGroupLimit), so a hot key sends at most one row
    per input partition.
    """
    window = Window.partitionBy(key).orderBy(*_earliest_first(df, key, moment))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def mark_duplicates(df: DataFrame, key: str, moment: str) -> DataFrame:
    """Every row, with ``is_duplicate`` TRUE on all but the earliest of its key.

    Keys are counted first, on the key alone and combined in the map tasks; rows whose key
    occurs once are passed through as they are. The rows of repeated keys are ranked in two
    steps. The first ranks within (key, input partition), a group no larger than one scan
    task. Its losers are duplicates; they stay in lanes of their own, and only the local
    leaders of a key meet in the second step.
    """
    repeated = (
        df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n")).filter("_n > 1")
    )
    # not hinted: Spark broadcasts the list below its threshold, else splits hot keys
    known = df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left")
    single = known.filter("_n IS NULL").select(*df.columns, F.lit(False).alias("is_duplicate"))
    order = _earliest_first(df, key, moment)
    placed = known.filter("_n IS NOT NULL").withColumn("_home", F.spark_partition_id())
    local = Window.partitionBy(key, "_home").orderBy(*order)
    ranked = placed.withColumn("_local", F.row_number().over(local)).withColumn(
        "_lane", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_home"))
    )
    meeting = Window.partitionBy(key, "_lane").orderBy(*order)
    return single.unionByName(
        ranked.withColumn("_rank", F.row_number().over(meeting))
        .withColumn("is_duplicate", (F.col("_local") > 1) | (F.col("_rank") > 1))
        .select(*df.columns, "is_duplicate")
    )
