from roadpulse.functions.exprs import (
    date_key,
    elapsed_seconds,
    first_known,
    haversine_km,
    round_half_away,
    settle,
    time_key,
)

__all__ = [
    "date_key",
    "elapsed_seconds",
    "first_known",
    "haversine_km",
    "round_half_away",
    "settle",
    "time_key",
]
