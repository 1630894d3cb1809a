from roadpulse.operators.dedup import first_copies, mark_duplicates
from roadpulse.operators.integrity import foreign_key_violations, primary_key_violations
from roadpulse.operators.numbering import number_rows
from roadpulse.operators.runs import mark_runs
from roadpulse.operators.slices import SLICE, crowded_slices
from roadpulse.operators.timeline import Runs, Timeline, open_timeline

__all__ = [
    "SLICE",
    "Runs",
    "Timeline",
    "crowded_slices",
    "first_copies",
    "foreign_key_violations",
    "mark_duplicates",
    "mark_runs",
    "number_rows",
    "open_timeline",
    "primary_key_violations",
]
