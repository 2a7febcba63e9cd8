"""Return-trip matching on Spark DataFrames.

    from homeward import tune, match_return_trips
    tune(spark)
    pairs = match_return_trips(trips)
"""

from .plans import (
    Layout,
    MatchSpec,
    count_candidates,
    count_return_trips,
    match_adjacent_slots,
    match_return_trips,
)
from .session import tune

__all__ = [
    "Layout",
    "MatchSpec",
    "count_candidates",
    "count_return_trips",
    "match_adjacent_slots",
    "match_return_trips",
    "tune",
]
