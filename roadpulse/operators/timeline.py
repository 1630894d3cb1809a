"""Ordered points per key, with look-back columns and runs, that survive a hot key.

Points are cut into slices of time (see ``slices``), so that a key with much of the data is
ordered by many tasks. Windows run per (key, slice), on one sort. What a slice needs from the ones
before it is one state per slice: its size, its last point, its first point, and per flag
the last place at which no run goes on. The states of a key merge in order, and one join
brings the result back to the points. There is one shape for every key and every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions import elapsed_seconds
from roadpulse.operators.slices import SLICE, sliced


@dataclass(frozen=True)
class Runs:
    """Runs of flagged neighbours. A run goes on while the point right before is flagged
    too and not more than ``max_gap_sec`` earlier (strictly: a gap of exactly that many
    seconds holds). Flags may use the look-back columns by their new names."""

    flags: dict[str, Column]
    moment: str
    previous_moment: str
    max_gap_sec: int

    def breaks(self, flag: Column) -> Column:
        """Whether no run reaches this point from before: it is not flagged, or too late."""
        late = elapsed_seconds(F.col(self.previous_moment), F.col(self.moment)) > self.max_gap_sec
        return ~F.coalesce(flag, F.lit(False)) | F.coalesce(late, F.lit(False))


@dataclass(frozen=True)
class Timeline:
    """Rows with a key (not NULL), an order, and the slice of the order they lie in."""

    frame: DataFrame
    key: str
    order: tuple[str, ...]

    @property
    def cell(self) -> list[str]:
        return [self.key, SLICE]

    def with_frame(self, frame: DataFrame) -> Timeline:
        return replace(self, frame=frame)

    def in_order(
        self, position: str, previous: dict[str, str], runs: Runs | None = None
    ) -> Timeline:
        """Add a 1-based position per key and, per entry of ``previous`` (new name
        -> column), that column's value at the point before; per flag of ``runs`` a number
        that the points of a run share (NULL where the flag is not raised): the place of
        the last break up to the point, 0 if there is none."""
        flags = runs.flags if runs else {}
        columns = self.frame.columns
        window = Window.partitionBy(*self.cell).orderBy(
            *[F.col(c).asc_nulls_last() for c in self.order]
        )
        so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        values = F.struct(*[F.col(c).alias(n) for n, c in previous.items()])
        local = self.frame.select(
            "*",
            F.row_number().over(window).cast("bigint").alias("_position"),
            F.lag(values).over(window).alias("_before"),
            F.lead(F.lit(True)).over(window).isNull().alias("_ends"),
        )
        # the first point of a slice is judged by the slice's state
        inner = local.select("*", *[F.col("_before")[n].alias(n) for n in previous]).select(
            *columns,
            "_position",
            "_before",
            "_ends",
            *[
                F.when((F.col("_position") > 1) & runs.breaks(flag), F.col("_position")).alias(
                    f"_break_{n}"
                )
                for n, flag in flags.items()
            ],
        )
        marked = inner.select(
            *columns,
            "_position",
            "_before",
            "_ends",
            *[F.max(f"_break_{n}").over(so_far).alias(f"_break_{n}") for n in flags],
        )
        # the two ends of a slice tell its whole state, as breaks run along
        carried = self._merged(
            marked.filter("_position = 1 OR _ends").groupBy(*self.cell).agg(
                F.max("_position").alias("_size"),
                F.max_by(values, F.col("_position")).alias("_tail"),
                F.min_by(F.struct(*columns), F.col("_position")).alias("_first"),
                *[F.max(f"_break_{n}").alias(f"_last_{n}") for n in flags],
            ),
            previous,
            runs,
        )
        opens = F.col("_position") == 1
        placed = marked.join(carried, self.cell).select(
            *columns,
            (F.col("_offset") + F.col("_position")).alias(position),
            *[
                F.when(opens, F.col("_handed")[n]).otherwise(F.col("_before")[n]).alias(n)
                for n in previous
            ],
            *[
                F.coalesce(F.col("_offset") + F.col(f"_break_{n}"), F.col(f"_open_{n}")).alias(
                    f"_run_{n}"
                )
                for n in flags
            ],
        )
        return self.with_frame(
            placed.select(
                *columns,
                position,
                *previous,
                *[F.when(flag, F.col(f"_run_{n}")).alias(n) for n, flag in flags.items()],
            )
        )

    def _merged(self, states: DataFrame, previous: dict[str, str], runs: Runs | None) -> DataFrame:
        """What each slice receives: the points before it, the last of them, and per flag
        the last break up to and including its first point. One row per key and slice."""
        flags = runs.flags if runs else {}
        line = Window.partitionBy(self.key).orderBy(SLICE)
        earlier = line.rowsBetween(Window.unboundedPreceding, -1)
        handed = states.select(
            *self.cell,
            "_first",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
            F.lag("_tail").over(line).alias("_handed"),
            *[f"_last_{n}" for n in flags],
        )
        if not flags:
            return handed.drop("_first")
        first = [
            F.col("_first")[f.name].alias(f.name)
            for f in states.schema["_first"].dataType.fields
            if f.name not in self.cell
        ]
        seen = handed.select(
            *self.cell,
            *first,
            *[F.col("_handed")[n].alias(n) for n in previous],
            "_offset",
            "_handed",
            *[f"_last_{n}" for n in flags],
        )
        broken = seen.select(
            *self.cell,
            "_offset",
            "_handed",
            *[f"_last_{n}" for n in flags],
            *[
                F.when(runs.breaks(flag), F.col("_offset") + 1).alias(f"_at_{n}")
                for n, flag in flags.items()
            ],
        )
        return broken.select(
            *self.cell,
            "_offset",
            "_handed",
            *[
                F.coalesce(
                    F.col(f"_at_{n}"),
                    F.max(
                        F.coalesce(F.col("_offset") + F.col(f"_last_{n}"), F.col(f"_at_{n}"))
                    ).over(earlier),
                    F.lit(0),
                ).alias(f"_open_{n}")
                for n in flags
            ],
        )


def open_timeline(
    df: DataFrame, key: str, order: tuple[str, str], rounds: Sequence[DataFrame] = ()
) -> Timeline:
    """The timeline of ``df``, ordered by a time and an id, in slices of a day; ``rounds``
    are the crowded ones that are cut further. Rows without a time come last."""
    return Timeline(sliced(df, key, order, rounds), key, order)
