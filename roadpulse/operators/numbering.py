"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import Workspace


def number_rows(
    df: DataFrame, name: str, order: list[str], workspace: Workspace
) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... over all rows in ``order`` (ascending, NULLs last).

    A range shuffle sorts the rows into contiguous partitions however the values
    are spread; each row keeps its partition and place there. The sorted table is
    written, since partition bounds are sampled, and read back; adding the sizes
    of the partitions before turns places into numbers. The window below runs
    over one row per partition, not over the data. ``df`` should be cheap to read,
    since sampling reads it once more.
    """
    sort = [F.col(c).asc_nulls_last() for c in order]
    placed = workspace.cut(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            # per partition this counts 0, 1, 2, ... in its lower 33 bits
            F.expr("monotonically_increasing_id() & 8589934591").alias("_place"),
        ),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_place") + 1).alias(name), *df.columns
    )
