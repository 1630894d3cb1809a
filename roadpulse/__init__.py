"""Fleet-telemetry analytics as Spark DataFrame plans."""

from roadpulse.model import Fleet
from roadpulse.settings import Settings
from roadpulse.sources import RawTables

__all__ = ["Fleet", "RawTables", "Settings"]
