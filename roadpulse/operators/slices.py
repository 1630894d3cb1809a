"""Slices of an order that no key can crowd.

A slice is a day of a key, or the rows without a time. One that holds too many rows is cut
again, into parts of its own span of time, or by the beginnings of the ids where all its
rows share one time; then the parts that are still too large, and so on. Only crowded slices
are cut, and which ones are is counted, not sampled. Names of slices sort like their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"

#: A crowded slice is cut into this many parts of time.
PARTS = 64
#: The lists of crowded slices go to all tasks: a slice is crowded only from this share of
#: all rows on, so that a list has no more entries, whatever the number of rows.
MOST_CROWDED = 100_000
#: Rounds of cutting; what is still crowded then stays whole, with the same results.
ROUNDS = 16


def _day(moment: str) -> Column:
    return F.coalesce(F.to_date(moment).cast("string"), F.lit("~"))


def _micros(moment: str) -> Column:
    """Microseconds since midnight of a time without zone."""
    seconds = F.extract(F.lit("SECOND"), moment) * 1_000_000
    return (F.hour(moment) * 3600 + F.minute(moment) * 60) * F.lit(1_000_000).cast(
        "bigint"
    ) + seconds.cast("bigint")


def _part(order: tuple[str, str]) -> Column:
    """The name of the part of a crowded slice that a row lies in."""
    moment, row_id = order
    by_id = F.when(F.col(row_id).isNull(), F.lit("j")).otherwise(
        F.concat(F.lit("i"), F.substring(row_id, F.lit(1), F.col("_chars")))
    )
    nth = F.floor((_micros(moment) - F.col("_from")) / F.col("_step"))
    nth = F.greatest(F.lit(0), F.least(F.lit(PARTS - 1), nth)).cast("string")
    by_time = F.concat(F.lit("T"), F.lpad(nth, 2, "0"))
    return F.concat(F.col(SLICE), F.when(F.col("_tied"), by_id).otherwise(by_time))


def _shared_beginning(a: Column, b: Column) -> Column:
    lengths = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(a)))
    one = F.lit(1)
    return F.size(F.filter(lengths, lambda n: F.substring(a, one, n) == F.substring(b, one, n)))


def crowded_slices(
    rows: DataFrame,
    key: str,
    order: tuple[str, str],
    limit: int,
    cut: Callable[[DataFrame, str], DataFrame],
) -> list[DataFrame]:
    """Slices of ``rows`` with more than ``limit`` rows, a written list for each round of
    cutting. ``order`` is a time without zone and a text id.

    One pass over the key and the time, combined in the map tasks, finds that there is
    none; each round then reads only the rows of slices that were cut before it.
    """
    moment, row_id = order
    cell = [key, SLICE]
    left = rows.filter(F.col(key).isNotNull()).select(key, *order, _day(moment).alias(SLICE))
    total, most = left.groupBy(*cell).count().agg(F.sum("count"), F.max("count")).first()
    if (most or 0) <= limit:
        return []
    limit = max(limit, total // MOST_CROWDED)
    rounds: list[DataFrame] = []
    while len(rounds) < ROUNDS:
        low, high = F.col("_low"), F.col("_high")
        counted = left.groupBy(*cell).agg(
            F.count("*").alias("_n"),
            F.min(moment).alias("_first"),
            F.max(moment).alias("_last"),
            F.min(row_id).alias("_low"),
            F.max(row_id).alias("_high"),
        )
        tied = F.col("_first").eqNullSafe(F.col("_last"))
        crowded = cut(
            counted.filter((F.col("_n") > limit) & (~tied | (low < high))).select(
                *cell,
                tied.alias("_tied"),
                _micros("_first").alias("_from"),
                F.ceil((_micros("_last") - _micros("_first") + 1) / PARTS).alias("_step"),
                # two more characters than all ids share: at least two parts, few enough
                F.coalesce(_shared_beginning(low, high) + 2, F.lit(0)).alias("_chars"),
            ),
            "crowded",
        )
        if crowded.isEmpty():
            break
        rounds.append(crowded)
        left = left.join(F.broadcast(crowded), cell).select(
            key, *order, _part(order).alias(SLICE)
        )
    return rounds


def sliced(
    df: DataFrame, key: str, order: tuple[str, str], rounds: Sequence[DataFrame] = ()
) -> DataFrame:
    """``df`` with the slice of each row."""
    columns = df.columns
    out = df.withColumn(SLICE, _day(order[0]))
    for crowded in rounds:
        out = out.join(F.broadcast(crowded), [key, SLICE], "left").select(
            *columns,
            F.when(F.col("_tied").isNotNull(), _part(order)).otherwise(F.col(SLICE)).alias(SLICE),
        )
    return out
