"""Key checks: Spark enforces no constraints, so these count what breaks them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def primary_key_violations(
    tables: dict[str, DataFrame], keys: list[tuple[str, list[str]]]
) -> DataFrame:
    """Per key: how many values occur more than once, and rows with a NULL in it.

    Counts are combined per map task before the shuffle; a key never meets its
    rows.
    """

    def check(table: str, columns: list[str]) -> DataFrame:
        per_value = tables[table].groupBy(*columns).agg(F.count("*").alias("_rows"))
        has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
        return per_value.agg(
            F.count_if(~has_null & (F.col("_rows") > 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(has_null, F.col("_rows"))), F.lit(0)).alias("null_keys"),
        ).select(
            F.lit(table).alias("table_name"),
            F.lit(", ".join(columns)).alias("key_columns"),
            "duplicate_keys",
            "null_keys",
        )

    return reduce(DataFrame.unionByName, [check(t, c) for t, c in keys])


def foreign_key_violations(
    tables: dict[str, DataFrame], edges: list[tuple[str, str, str]]
) -> DataFrame:
    """Per edge (child, parent, column): child rows whose non-NULL value is missing
    in the parent.

    One pass over each child counts its rows per key and value, so the anti join moves
    one row per distinct value and a hot value costs nothing.
    """
    children = list(dict.fromkeys(child for child, _, _ in edges))

    def used(child: str) -> DataFrame:
        keys = [
            F.struct(
                F.lit(child).alias("child_table"),
                F.lit(parent).alias("parent_table"),
                F.lit(column).alias("key_column"),
                F.col(column).cast("string").alias("value"),
            )
            for c, parent, column in edges
            if c == child
        ]
        return (
            tables[child]
            .select(F.inline(F.array(*keys)))
            .filter("value IS NOT NULL")
            .groupBy("child_table", "parent_table", "key_column", "value")
            .agg(F.count("*").alias("_rows"))
        )

    parents = [
        tables[parent].select(
            F.lit(parent).alias("parent_table"),
            F.lit(column).alias("key_column"),
            F.col(column).cast("string").alias("value"),
        )
        for parent, column in dict.fromkeys((p, c) for _, p, c in edges)
    ]
    names = ["child_table", "parent_table", "key_column"]
    every = reduce(DataFrame.unionByName, [used(c) for c in children])
    known = reduce(DataFrame.unionByName, parents)
    orphans = (
        every.join(known, ["parent_table", "key_column", "value"], "left_anti")
        .groupBy(*names)
        .agg(F.sum("_rows").alias("_rows"))
    )
    rows = ", ".join(f"('{c}', '{p}', '{k}')" for c, p, k in edges)
    asked = tables[children[0]].sparkSession.sql(
        f"SELECT * FROM VALUES {rows} AS t({', '.join(names)})"
    )
    return asked.join(orphans, names, "left").select(
        *names, F.coalesce("_rows", F.lit(0)).alias("orphan_rows")
    )
