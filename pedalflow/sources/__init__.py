from .drift import drift_of_lines, schema_drift
from .proxy import event_hours, part_points, proxy_stations, proxy_trips, table, with_holes
from .sinks import to_pandas, write_quarantine, write_table
from .stations import (
    read_station_points_kml,
    read_station_points_xml,
    read_stations_csv,
    station_rows,
    stations_from_rows,
)
from .trips import (
    good_rows,
    load_trips,
    normalise_trips,
    parse_trip_lines,
    quarantine,
    read_trips_json,
    trips_from_raw,
    union_by_name,
    union_dedupe,
    with_reason,
)

__all__ = [
    "drift_of_lines",
    "event_hours",
    "good_rows",
    "load_trips",
    "normalise_trips",
    "parse_trip_lines",
    "part_points",
    "proxy_stations",
    "proxy_trips",
    "quarantine",
    "read_station_points_kml",
    "read_station_points_xml",
    "read_stations_csv",
    "read_trips_json",
    "schema_drift",
    "station_rows",
    "stations_from_rows",
    "table",
    "trips_from_raw",
    "to_pandas",
    "union_by_name",
    "union_dedupe",
    "with_holes",
    "with_reason",
    "write_quarantine",
    "write_table",
]
