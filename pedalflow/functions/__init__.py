from .buckets import season_bucket, weekend_bucket
from .calendar import (
    date_of_text,
    day_text,
    hour_of_text,
    iso_weekday,
    time_text,
    weekday_name,
    with_calendar,
    year_of_week,
)
from .keys import exact_station_number, station_number

__all__ = [
    "date_of_text",
    "day_text",
    "exact_station_number",
    "hour_of_text",
    "iso_weekday",
    "season_bucket",
    "station_number",
    "time_text",
    "weekday_name",
    "weekend_bucket",
    "with_calendar",
    "year_of_week",
]
