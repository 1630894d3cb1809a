"""Gaps and islands: runs of flagged neighbours share a number."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.operators.timeline import Runs, Timeline


def mark_runs(
    timeline: Timeline,
    flags: dict[str, Column],
    position: str,
    moment: str,
    previous_moment: str,
    max_gap_sec: int,
) -> Timeline:
    """Keep the points that any flag is raised on and add, per flag, a number that the
    points of a run share (NULL where the flag is not raised).

    The general form, for points that may have been ordered before; what orders points
    anew passes ``Runs`` to ``Timeline.in_order``, which finds both in one pass.
    """
    kept = [c for c in timeline.frame.columns if c not in (position, previous_moment)]
    again = timeline.with_frame(timeline.frame.select(*kept)).in_order(
        position, {previous_moment: moment}, Runs(flags, moment, previous_moment, max_gap_sec)
    )
    raised = reduce(or_, [F.col(n).isNotNull() for n in flags])
    return again.with_frame(
        again.frame.filter(raised).select(*timeline.frame.columns, *flags)
    )
