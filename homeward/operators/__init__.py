from .balanced import balanced_join, heavy_keys, keyed_join
from .clean import clean, distinct_rows, nonzero_coordinates, positive_duration
from .distance_count import count_distance_pairs
from .expand import explode_keys, neighbour_clones, time_clones, with_cells, with_time_slot
from .joins import count_gap_pairs, distance_gap_join, distance_join, gap_join
from .summary import count_rows, first_rows

__all__ = [
    "balanced_join",
    "clean",
    "count_distance_pairs",
    "count_gap_pairs",
    "count_rows",
    "distance_gap_join",
    "distance_join",
    "distinct_rows",
    "explode_keys",
    "first_rows",
    "gap_join",
    "heavy_keys",
    "keyed_join",
    "neighbour_clones",
    "nonzero_coordinates",
    "positive_duration",
    "time_clones",
    "with_cells",
    "with_time_slot",
]
