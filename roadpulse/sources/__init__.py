from roadpulse.sources.raw import RawTables, load_raw, speed_limits
from roadpulse.sources.testbed import load_testbed

__all__ = ["RawTables", "load_raw", "load_testbed", "speed_limits"]
