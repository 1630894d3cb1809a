"""Business rules of the warehouse, as one immutable parameter object."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

# Speed limit in km/h per vehicle type.
SPEED_LIMITS = [("BIKE", 60), ("3W", 50), ("LCV", 80), ("HCV", 70)]

# Names of the three anomaly types and of the stand-in driver.
OVERSPEEDING = "OVERSPEEDING"
EXCESSIVE_IDLING = "EXCESSIVE_IDLING"
GPS_JUMP = "GPS_JUMP"
ANOMALY_TYPES = [EXCESSIVE_IDLING, GPS_JUMP, OVERSPEEDING]
UNKNOWN_DRIVER = "UNKNOWN"


@dataclass(frozen=True)
class Settings:
    """Thresholds default to the published rules; every comparison's strictness
    is stated where it is used."""

    # first day of the calendar; None takes the first day seen in the telemetry
    first_day: date | None = date(2025, 1, 20)
    # telemetry at or after this instant is out of range
    window_end: datetime = datetime(2025, 1, 27)
    latitude_bounds: tuple[float, float] = (6.0, 36.0)
    longitude_bounds: tuple[float, float] = (68.0, 97.0)

    # longest time one pair of neighbouring points may account for
    segment_cap_sec: int = 300
    # a run of flagged points ends when the next one is later than this
    run_gap_sec: int = 120
    idle_alarm_sec: int = 900
    idle_medium_sec: int = 1800
    idle_high_sec: int = 3600
    jump_kmph: float = 200.0
    overspeed_high_ratio: float = 1.2
    earth_radius_km: float = 6371.0

    @property
    def last_day(self) -> date:
        return (self.window_end - timedelta(days=1)).date()
