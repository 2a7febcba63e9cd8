"""Return-trip matching over a trip stream.

The same keys and predicates as the batch match, as a Structured
Streaming stream-stream inner join of the trip stream with itself.  The
join's event-time range (``b.pickup`` after ``a.dropoff`` and less than
``max_gap_s`` later) lets Spark evict join state once the watermarks
pass it.

``lateness`` bounds the state: Spark drops a trip that arrives more than
``lateness`` behind the latest event time it has seen, the usual streaming
contract, stated here because the batch match never drops.  ``None`` keeps
all state (exact, for bounded sources such as a directory read with
``trigger(availableNow=True)``); it must be asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import TIME_SLOT_S, GridSpec
from ..operators.balanced import keyed_join
from ..plans.return_trips import (
    PAIR_COLUMNS,
    MatchSpec,
    _fine_back,
    _fine_keys,
    _fine_to,
    _residual,
    _role,
    matchable,
    trip_table,
)
from ..sources.schema import YELLOW_CAB, TripColumns


def stream_return_trips(
    trips: DataFrame,
    radius_m: float = 100.0,
    max_gap_s: int = 28800,
    *,
    lateness: str | None,
    grid: GridSpec | None = None,
    slot_width_s: int = TIME_SLOT_S,
    cols: TripColumns = YELLOW_CAB,
) -> DataFrame:
    """Pairs (trip, return trip) as they become known; append mode.

    ``trips`` is a streaming DataFrame with TIMESTAMP event times.
    """
    spec = MatchSpec(radius_m=radius_m, max_gap_s=max_gap_s, grid=grid, slot_width_s=slot_width_s)
    base = matchable(trip_table(trips, cols))
    to = _fine_to(_role(base, "to"), spec)
    back = _fine_back(_role(base, "back"), spec)
    if lateness is not None:
        to = to.withWatermark("to_dropoff_ts", lateness)
        back = back.withWatermark("back_pickup_ts", lateness)
    # event-time range on the raw timestamps: what the state store can evict by
    window = (F.col("back_pickup_ts") > F.col("to_dropoff_ts")) & (
        F.col("back_pickup_ts") < F.col("to_dropoff_ts") + F.make_interval(secs=F.lit(max_gap_s))
    )
    joined = keyed_join(to, back, _fine_keys(spec), window & _residual(spec, base))
    return joined.select(*PAIR_COLUMNS)
