from .geo import EARTH_RADIUS_M, epoch_seconds, haversine_m
from .grid import (
    METRIC,
    UNIFORM_176,
    CellKeys,
    GridSpec,
    SlotKeys,
    metric_grid,
    time_slot,
)

__all__ = [
    "EARTH_RADIUS_M",
    "METRIC",
    "UNIFORM_176",
    "CellKeys",
    "GridSpec",
    "SlotKeys",
    "epoch_seconds",
    "haversine_m",
    "metric_grid",
    "time_slot",
]
