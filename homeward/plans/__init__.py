from .return_trips import (
    ADJACENT_COLUMNS,
    ADJACENT_SPEC,
    CANONICAL_SPEC,
    PAIR_COLUMNS,
    Layout,
    MatchSpec,
    count_candidates,
    count_return_trips,
    join_partitions,
    match_adjacent_slots,
    match_pairs,
    match_return_trips,
    matchable,
    return_trip_candidates,
    spread,
    trip_table,
)

__all__ = [
    "ADJACENT_COLUMNS",
    "ADJACENT_SPEC",
    "CANONICAL_SPEC",
    "PAIR_COLUMNS",
    "Layout",
    "MatchSpec",
    "count_candidates",
    "count_return_trips",
    "join_partitions",
    "match_adjacent_slots",
    "match_pairs",
    "match_return_trips",
    "matchable",
    "return_trip_candidates",
    "spread",
    "trip_table",
]
