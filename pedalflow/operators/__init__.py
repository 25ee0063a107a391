from .broadcast import MAX_BROADCAST_ROWS, bounded_broadcast, is_bounded
from .ranking import pick_one, top_n
from .stats import add_relative_spread, extremes, minmax_scale, summarise_counts, unit_counts
from .wide import distinct_years, pivot_years
from .zoning import (
    locate,
    lost_rows,
    station_map,
    station_pair_weighted_counts,
    zone_centroids,
    zone_pair_counts,
    zone_trips,
)

__all__ = [
    "MAX_BROADCAST_ROWS",
    "add_relative_spread",
    "bounded_broadcast",
    "distinct_years",
    "extremes",
    "is_bounded",
    "locate",
    "lost_rows",
    "minmax_scale",
    "pick_one",
    "pivot_years",
    "station_map",
    "station_pair_weighted_counts",
    "summarise_counts",
    "top_n",
    "unit_counts",
    "zone_centroids",
    "zone_pair_counts",
    "zone_trips",
]
