"""Independent SQL formulations of the registered queries (DuckDB dialect).

Written the straightforward way -- separate aggregates joined, explicit
filters -- so they check the Spark plans rather than mirror them.  Tables are
the driver's views (``lineitem``, ``supplier``, ``nation``, ``region``,
``part``, ``events``); the proxy trips and stations are rebuilt in a common
prefix.
"""

from __future__ import annotations

BASE = """
WITH nsup AS (SELECT count(*) AS s FROM supplier),
ends AS (
  SELECT *, CASE WHEN l_suppkey % 10 = 5 THEN l_suppkey + 1 ELSE l_suppkey END AS u,
         l_partkey % (nsup.s + nsup.s // 10) AS p, CAST(l_shipdate AS DATE) AS d0
  FROM lineitem CROSS JOIN nsup),
days AS (SELECT *, CASE WHEN u % 10 = 7 AND month(d0) <= 2 THEN d0 + 60 ELSE d0 END AS d1 FROM ends),
trips AS (
  SELECT l_orderkey AS trip_id, l_returnflag AS user_type, l_linenumber - 1 AS age_range,
         CASE WHEN l_quantity <> 13 THEN CAST(l_quantity AS BIGINT) END AS travel_time, u AS unplug_station,
         CASE WHEN p % 10 = 0 THEN p + 1 ELSE p END AS plug_station,
         l_linestatus AS unplug_base, l_linestatus AS plug_base,
         CASE WHEN year(d1) = 1995 AND dayofweek(d1) = 0 THEN d1 + 1 ELSE d1 END AS trip_date,
         CAST(hour(l_shipdate) AS INTEGER) AS trip_hour
  FROM days),
stations AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS station_key, s_suppkey AS station,
         CASE s_suppkey % 10 WHEN 0 THEN 'DEPARTURES ONLY' WHEN 5 THEN 'ARRIVALS ONLY' WHEN 7 THEN 'NO WINTER'
              ELSE n_name END AS zone, r_name AS district,
         CAST(s_acctbal AS DOUBLE) AS lat, CAST(s_nationkey AS DOUBLE) AS lon
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
smap AS (SELECT station, min(zone) AS zone FROM stations WHERE station IS NOT NULL GROUP BY station),
centroids AS (SELECT zone, avg(lat) AS lat, avg(lon) AS lon, count(*) AS n_stations FROM stations GROUP BY zone),
dated AS (
  SELECT *, CAST(dayofweek(trip_date) + 1 AS INTEGER) AS dayofweek, CAST(month(trip_date) AS INTEGER) AS month,
         CAST(weekofyear(trip_date) AS INTEGER) AS weekofyear, CAST(year(trip_date) AS INTEGER) AS year
  FROM trips),
zoned AS (
  SELECT d.*, o.zone AS origin_zone, p.zone AS dest_zone
  FROM dated d JOIN smap o ON d.unplug_station = o.station JOIN smap p ON d.plug_station = p.station)
"""

# Years present in the driver tables (fixed: the pivot columns of the oracle).
YEARS = list(range(1995, 2002))


WEEKDAY_LIST = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"


def _pivot(keys: str, inner: bool = True, names: bool = False) -> str:
    cols = ", ".join(f'nullif(count(*) FILTER (WHERE year = {y}), 0) AS "{y}"' for y in YEARS)
    having = " AND ".join(f"count(*) FILTER (WHERE year = {y}) > 0" for y in YEARS)
    extra = f", {WEEKDAY_LIST}[dayofweek] AS weekday_name" if names else ""
    sql = f"SELECT {keys}, {cols}{extra} FROM zoned_k GROUP BY {keys}"
    return f"{sql} HAVING {having}" if inner else sql


def _stats(bucket_expr: str | None, unit: str, src: str = "zoned") -> str:
    """Two-level stats; ``bucket_expr`` None for the plain study."""
    b = f"{bucket_expr} AS bucket, " if bucket_expr else ""
    g = "year, bucket" if bucket_expr else "year"
    return f"""
, c AS (SELECT year, {b}origin_zone AS zone, {unit}, count(*) AS n_trips FROM {src} GROUP BY ALL)
, s AS (SELECT {g}, zone, avg(n_trips) AS mean_trips, stddev_samp(n_trips) AS std_trips,
               min(n_trips) AS min_trips, max(n_trips) AS max_trips, count(*) AS n_units
        FROM c GROUP BY ALL)
, r AS (SELECT s.*, std_trips / mean_trips * max(mean_trips) OVER (PARTITION BY {g}) AS std_scaled,
               (max_trips - min_trips) / mean_trips AS spread,
               CASE WHEN max(mean_trips) OVER (PARTITION BY {g}) = min(mean_trips) OVER (PARTITION BY {g}) THEN 0.0
                    ELSE (mean_trips - min(mean_trips) OVER (PARTITION BY {g}))
                         / (max(mean_trips) OVER (PARTITION BY {g}) - min(mean_trips) OVER (PARTITION BY {g})) END
                 AS mean_scaled
        FROM s)
"""


def _stats_select(bucket: bool) -> str:
    b = "bucket, " if bucket else ""
    return f"""
SELECT year, {b}zone, round(mean_trips, 6) AS mean_trips, round(std_trips, 6) AS std_trips, min_trips, max_trips,
       n_units, round(std_scaled, 6) AS std_scaled, round(spread, 6) AS spread, round(mean_scaled, 6) AS mean_scaled,
       round(ce.lat, 6) AS lat, round(ce.lon, 6) AS lon
FROM r LEFT JOIN centroids ce USING (zone)
"""


def _extremes(bucket: bool) -> str:
    g = "year, bucket" if bucket else "year"
    b = "bucket, " if bucket else ""
    return f"""
, m AS (SELECT {g}, zone, 'std_scaled' AS metric, std_scaled AS value FROM r
        UNION ALL SELECT {g}, zone, 'spread' AS metric, spread AS value FROM r)
SELECT year, {b}zone, metric, round(value, 6) AS value,
       row_number() OVER (PARTITION BY {g}, metric ORDER BY zone) = 1 AS is_label FROM (
  SELECT *, rank() OVER (PARTITION BY {g}, metric ORDER BY value DESC) AS rk FROM m WHERE value IS NOT NULL)
WHERE rk = 1
"""


SEASON = ("CASE WHEN month BETWEEN 3 AND 6 THEN 'spring' WHEN month BETWEEN 7 AND 9 THEN 'summer' "
          "WHEN month BETWEEN 10 AND 12 THEN 'autumn' WHEN month BETWEEN 1 AND 2 THEN 'winter' END")
WEEKEND = "CASE WHEN dayofweek IN (6, 7, 1) THEN 'weekend' ELSE 'weekday' END"
WEEKEND_AS_CODED = "CASE WHEN dayofweek >= 4 THEN 'weekend' ELSE 'weekday' END"

# The coordinate join per station row, as the studied code ran it (S2): every trip
# repeated n(origin zone rows) x n(destination zone rows) times.
FAN = """
, fan AS (SELECT z.* FROM zoned z JOIN stations so ON so.zone = z.origin_zone JOIN stations sd ON sd.zone = z.dest_zone)
"""

BALANCE = """
, o AS (SELECT year, origin_zone AS zone, count(*) AS n_out FROM zoned GROUP BY ALL)
, i AS (SELECT year, dest_zone AS zone, count(*) AS n_in FROM zoned GROUP BY ALL)
, b AS (SELECT year, zone, n_out, n_in, n_out - n_in AS difference,
               greatest(n_out - n_in, 0) AS more_out, greatest(n_in - n_out, 0) AS more_in
        FROM o JOIN i USING (year, zone))
"""

BALANCE_FULL = """
, o AS (SELECT year, origin_zone AS zone, count(*) AS n_out FROM zoned GROUP BY ALL)
, i AS (SELECT year, dest_zone AS zone, count(*) AS n_in FROM zoned GROUP BY ALL)
, f AS (SELECT coalesce(o.year, i.year) AS year, coalesce(o.zone, i.zone) AS zone,
               coalesce(n_out, 0) AS n_out, coalesce(n_in, 0) AS n_in
        FROM o FULL OUTER JOIN i ON o.year = i.year AND o.zone = i.zone)
, b AS (SELECT year, zone, n_out, n_in, n_out - n_in AS difference,
               greatest(n_out - n_in, 0) AS more_out, greatest(n_in - n_out, 0) AS more_in FROM f)
"""

BALANCE_COLS = "year, zone, n_out, n_in, difference, more_out, more_in, round(ce.lat, 6) AS lat, round(ce.lon, 6) AS lon"


def _minmax(c: str) -> str:
    w = "OVER (PARTITION BY year)"
    return (f"round(CASE WHEN max({c}) {w} = min({c}) {w} THEN 0.0 "
            f"ELSE ({c} - min({c}) {w}) / (max({c}) {w} - min({c}) {w}) END, 6)")


def _lloyd(points: str, ks: str, seed: int, unit: int, steps: int) -> str:
    """CTEs of k-means for all ``ks`` over ``points`` (station, x, y): ``g`` (grid points) and ``a`` (k, station, c).

    Seeds are the farthest points; a step takes means rounded down.
    """
    k = max(int(x) for x in ks.split(","))
    z = "CAST(floor(1000000 * (({0} - s{0} / n) / sqrt((q{0} - s{0} * s{0} / n) / (n - 1)))) AS BIGINT) AS {0}"
    sql = f"""
raw AS (SELECT station, CAST(round(x * {unit}) AS BIGINT) AS x, CAST(round(y * {unit}) AS BIGINT) AS y FROM {points}
        WHERE x IS NOT NULL AND y IS NOT NULL),
mm AS (SELECT count(*) AS n, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(x * x) AS DOUBLE) AS qx,
              CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(y * y) AS DOUBLE) AS qy FROM raw),
g AS MATERIALIZED (SELECT station, {z.format("x")}, {z.format("y")} FROM raw CROSS JOIN mm),
e0 AS MATERIALIZED (SELECT 0 AS c, x, y FROM g ORDER BY md5(CAST(station AS VARCHAR) || '{seed}'), station LIMIT 1),"""
    for i in range(1, k):
        sql += f"""
e{i} AS MATERIALIZED (
  SELECT * FROM e{i - 1} UNION ALL
  SELECT * FROM (SELECT {i} AS c, g.x, g.y FROM g CROSS JOIN e{i - 1} e GROUP BY station, g.x, g.y
                 ORDER BY min((g.x - e.x) * (g.x - e.x) + (g.y - e.y) * (g.y - e.y)) DESC, station LIMIT 1)),"""
    sql += f"""
c0 AS MATERIALIZED (SELECT k, c, x, y FROM e{k - 1} JOIN (SELECT unnest([{ks}]) AS k) ON c < k),"""
    for i in range(steps + 1):
        sql += f"""
a{i} AS MATERIALIZED (
  SELECT k, station, c FROM (
    SELECT k, station, c, row_number() OVER (PARTITION BY k, station ORDER BY (g.x - m.x) * (g.x - m.x) + (g.y - m.y) * (g.y - m.y), c) AS nth
    FROM g CROSS JOIN c{i} m) WHERE nth = 1),
c{i + 1} AS MATERIALIZED (
  SELECT k, c, coalesce(CAST(floor(sx / n) AS BIGINT), x) AS x, coalesce(CAST(floor(sy / n) AS BIGINT), y) AS y FROM c{i}
  LEFT JOIN (SELECT k, c, CAST(sum(x) AS BIGINT) AS sx, CAST(sum(y) AS BIGINT) AS sy, count(*) AS n
             FROM a{i} JOIN g USING (station) GROUP BY k, c) USING (k, c)),"""
    return sql + f"\na AS (SELECT * FROM a{steps})"


# Columns of an export and the JSON types they are written with.
DRIFT_COLUMNS = {
    "_id": "OBJECT<`$oid`: STRING>", "user_day_code": "STRING", "idplug_base": "BIGINT", "idplug_station": "BIGINT",
    "idunplug_base": "BIGINT", "idunplug_station": "BIGINT", "travel_time": "BIGINT", "ageRange": "BIGINT",
    "user_type": "BIGINT", "unplug_hourTime": "OBJECT<`$date`: STRING>", "zip_code": "STRING",
    "track": "OBJECT<from: BIGINT, to: BIGINT>", "_id.$oid": "STRING", "unplug_hourTime.$date": "STRING",
    "track.from": "BIGINT", "track.to": "BIGINT",
}


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dated_trips"] = BASE + """
SELECT trip_id, age_range, unplug_station, plug_station, strftime(trip_date, '%Y-%m-%d') AS trip_date, dayofweek,
       CAST(dayofyear(trip_date) AS INTEGER) AS dayofyear, CAST(dayofmonth(trip_date) AS INTEGER) AS dayofmonth,
       month, weekofyear, year, dayname(trip_date) AS weekday_name, CAST(isodow(trip_date) AS INTEGER) AS iso_weekday,
       CAST(isoyear(trip_date) AS INTEGER) AS week_year
FROM dated"""
    q["zoned_trips_counts"] = BASE + "SELECT origin_zone, dest_zone, count(*) AS n_trips FROM zoned GROUP BY ALL"
    q["located_zones"] = BASE + """
SELECT zone, round(lat, 6) AS lat, round(lon, 6) AS lon, n_stations FROM centroids"""
    q["station_pair_weighted_counts"] = BASE + """
SELECT z.origin_zone, z.dest_zone, count(*) AS n_trips, count(*) * co.n_stations * cd.n_stations AS n_rows_as_coded
FROM zoned z JOIN centroids co ON co.zone = z.origin_zone JOIN centroids cd ON cd.zone = z.dest_zone
GROUP BY z.origin_zone, z.dest_zone, co.n_stations, cd.n_stations"""
    q["years"] = BASE + "SELECT DISTINCT year FROM zoned"
    q["distinct_zone_count"] = BASE + """
SELECT count(DISTINCT origin_zone) AS n_origin_zones, count(DISTINCT dest_zone) AS n_dest_zones,
       count(DISTINCT unplug_station) AS n_origin_stations, count(DISTINCT plug_station) AS n_dest_stations
FROM zoned"""
    q["trips_by_weekday_year_total"] = BASE + ", zoned_k AS (SELECT * FROM zoned)\n" + _pivot("dayofweek", names=True)
    q["trips_by_weekday_year_zone"] = (
        BASE + ", zoned_k AS (SELECT *, origin_zone AS zone FROM zoned)\n" + _pivot("zone, dayofweek", names=True)
    )
    q["trips_by_weekday_year_outer"] = (
        BASE + ", zoned_k AS (SELECT * FROM zoned)\n" + _pivot("dayofweek", inner=False, names=True)
    )
    q["trips_by_week_year"] = BASE + ", zoned_k AS (SELECT * FROM zoned)\n" + _pivot("weekofyear")
    q["zone_stats"] = BASE + _stats(None, "dayofweek") + _stats_select(False)
    q["zone_stats_weekend"] = BASE + _stats(WEEKEND, "dayofweek") + _stats_select(True)
    q["zone_stats_weekend_as_coded"] = BASE + _stats(WEEKEND_AS_CODED, "dayofweek") + _stats_select(True)
    q["zone_stats_season"] = BASE + _stats(SEASON, "month") + _stats_select(True)
    q["zone_extremes"] = BASE + _stats(None, "dayofweek") + _extremes(False)
    q["zone_extremes_weekend"] = BASE + _stats(WEEKEND, "dayofweek") + _extremes(True)
    q["zone_extremes_season"] = BASE + _stats(SEASON, "month") + _extremes(True)
    q["zone_balance"] = BASE + BALANCE + f"SELECT {BALANCE_COLS} FROM b LEFT JOIN centroids ce USING (zone)"
    q["trips_by_weekday_year_as_coded"] = (
        BASE + FAN + ", zoned_k AS (SELECT * FROM fan)\n" + _pivot("dayofweek", names=True)
    )
    q["trips_by_week_year_as_coded"] = BASE + FAN + ", zoned_k AS (SELECT * FROM fan)\n" + _pivot("weekofyear")
    q["zone_stats_as_coded"] = BASE + FAN + _stats(None, "dayofweek", src="fan") + _stats_select(False)
    q["zone_stats_season_as_coded"] = BASE + FAN + _stats(SEASON, "month", src="fan") + _stats_select(True)
    q["zone_stats_weekend_all_as_coded"] = (
        BASE + FAN + _stats(WEEKEND_AS_CODED, "dayofweek", src="fan") + _stats_select(True)
    )
    q["zone_balance_as_coded"] = (
        BASE + FAN + BALANCE.replace("FROM zoned", "FROM fan")
        + f"SELECT {BALANCE_COLS} FROM b LEFT JOIN centroids ce USING (zone)"
    )
    q["zone_balance_full"] = BASE + BALANCE_FULL + f"SELECT {BALANCE_COLS} FROM b LEFT JOIN centroids ce USING (zone)"
    q["zone_balance_scaled"] = BASE + BALANCE + f"""
SELECT {BALANCE_COLS}, {_minmax('more_out')} AS more_out_scaled, {_minmax('more_in')} AS more_in_scaled
FROM b LEFT JOIN centroids ce USING (zone)"""
    q["zone_balance_share"] = BASE + BALANCE + """
SELECT year, zone, n_out, n_in, difference,
       round(100.0 * n_out / sum(n_out) OVER (PARTITION BY year), 6) AS out_pct,
       round(100.0 * n_in / sum(n_in) OVER (PARTITION BY year), 6) AS in_pct,
       round(100.0 * (n_out + n_in) / sum(n_out + n_in) OVER (PARTITION BY year), 6) AS usage_pct
FROM b"""
    q["zone_in_out_demand"] = BASE + """
, arr AS (SELECT m.zone, count(*) AS arrivals FROM trips t LEFT JOIN smap m ON t.plug_station = m.station GROUP BY m.zone)
, dep AS (SELECT m.zone, count(*) AS departures FROM trips t LEFT JOIN smap m ON t.unplug_station = m.station GROUP BY m.zone)
SELECT arr.zone, arrivals, departures FROM arr LEFT JOIN dep ON dep.zone = arr.zone WHERE arr.zone IS NOT NULL"""
    q["growth_by_year"] = BASE + """
SELECT CAST(year(trip_date) AS INTEGER) AS year, count(*) AS n_trips,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM trips GROUP BY 1"""
    q["daily_peak"] = BASE + """
, c AS (SELECT trip_date, count(*) AS n FROM trips t JOIN smap m ON t.unplug_station = m.station GROUP BY trip_date)
SELECT n AS max_daily_trips, strftime(trip_date, '%Y-%m-%d') AS peak_date FROM c ORDER BY n DESC, trip_date LIMIT 1"""
    q["daily_peak_by_zone"] = BASE + """
, c AS (SELECT m.zone, trip_date, count(*) AS n FROM trips t JOIN smap m ON t.unplug_station = m.station GROUP BY ALL)
SELECT zone, n AS max_daily_trips, strftime(trip_date, '%Y-%m-%d') AS peak_date FROM c
QUALIFY row_number() OVER (PARTITION BY zone ORDER BY n DESC, trip_date) = 1"""
    q["station_balance"] = BASE + """
, u AS (SELECT unplug_station AS station, count(*) AS n_unplugs FROM trips GROUP BY 1)
, p AS (SELECT plug_station AS station, count(*) AS n_plugs FROM trips GROUP BY 1)
SELECT station, n_unplugs, n_plugs, n_unplugs - n_plugs AS difference FROM u JOIN p USING (station)"""
    q["station_balance_top10"] = BASE + """
, u AS (SELECT unplug_station AS station, count(*) AS n_unplugs FROM trips GROUP BY 1)
, p AS (SELECT plug_station AS station, count(*) AS n_plugs FROM trips GROUP BY 1)
SELECT station, n_unplugs, n_plugs, n_unplugs - n_plugs AS difference
FROM u JOIN p USING (station) ORDER BY difference DESC, station LIMIT 10"""
    usage = """
SELECT age_range, count(*) AS n_trips, CAST(sum(travel_time) AS BIGINT) AS total_travel_time,
       round(avg(travel_time), 6) AS mean_travel_time,
       round(sum(travel_time) / sum(sum(travel_time)) OVER (), 6) AS share_of_total
FROM trips {where} GROUP BY age_range"""
    q["usage_by_age"] = BASE + usage.format(where="")
    q["known_age_usage"] = BASE + usage.format(where="WHERE age_range <> 0")
    q["count_by_user_type"] = BASE + "SELECT user_type, count(*) AS n_trips FROM trips GROUP BY 1"
    q["count_by_age"] = BASE + "SELECT age_range, count(*) AS n_trips FROM trips GROUP BY 1"
    q["count_by_base"] = BASE + "SELECT plug_base, count(*) AS n_trips FROM trips GROUP BY 1"
    q["od_weekday_counts"] = BASE + """
SELECT unplug_station, dayofweek, plug_station, count(*) AS n_trips FROM dated GROUP BY ALL"""
    q["od_weekday_top"] = BASE + """
SELECT unplug_station, dayofweek, plug_station, count(*) AS n_trips FROM dated GROUP BY ALL
ORDER BY n_trips DESC, unplug_station, dayofweek, plug_station LIMIT 10"""
    q["od_selected_stations"] = BASE + """
, top AS (SELECT plug_station FROM trips GROUP BY 1 ORDER BY count(*) DESC, plug_station LIMIT 5)
SELECT unplug_station, dayofweek, plug_station, count(*) AS n_trips FROM dated
WHERE plug_station IN (SELECT plug_station FROM top) GROUP BY ALL"""
    above = """
, m AS (SELECT floor(sum(travel_time) / count(travel_time)) AS mean_floor FROM trips)
, a AS (SELECT age_range, count(*) FILTER (WHERE travel_time - m.mean_floor > 0) AS n_above, count(*) AS n_trips
        FROM trips CROSS JOIN m GROUP BY age_range)
"""
    q["travel_time_totals"] = BASE + """
SELECT count(*) AS n_trips, count(travel_time) AS n_known, CAST(sum(travel_time) AS BIGINT) AS total_travel_time,
       CAST(floor(sum(travel_time) / count(travel_time)) AS BIGINT) AS mean_floor
FROM trips"""
    q["above_average_by_age"] = BASE + above + "SELECT age_range, n_above FROM a WHERE n_above > 0"
    q["above_average_share"] = BASE + above + """
SELECT age_range, n_above, n_trips, round(n_above / n_trips, 6) AS share_above FROM a"""
    q["travel_time_by_age_summary"] = BASE + """
SELECT age_range, count(*) AS n_trips, min(travel_time) AS min_travel_time, max(travel_time) AS max_travel_time,
       round(CAST(quantile_cont(travel_time, 0.25) AS DOUBLE), 6) AS p25_travel_time,
       round(CAST(quantile_cont(travel_time, 0.5) AS DOUBLE), 6) AS p50_travel_time,
       round(CAST(quantile_cont(travel_time, 0.75) AS DOUBLE), 6) AS p75_travel_time
FROM trips GROUP BY age_range"""
    q["lost_rows"] = BASE + """
SELECT CASE WHEN o.station IS NULL AND p.station IS NULL THEN 'no_origin_no_destination'
            WHEN o.station IS NULL THEN 'no_origin' WHEN p.station IS NULL THEN 'no_destination'
            ELSE 'kept' END AS reason, count(*) AS n_trips
FROM trips t LEFT JOIN smap o ON t.unplug_station = o.station LEFT JOIN smap p ON t.plug_station = p.station
GROUP BY 1"""
    holes = BASE + """
, htrips AS (SELECT * REPLACE (CASE WHEN travel_time = 7 THEN NULL ELSE trip_date END AS trip_date) FROM trips)
, hmap AS (SELECT station, zone FROM smap WHERE station % 10 <> 3)
, hzoned AS (SELECT d.*, o.zone AS origin_zone, p.zone AS dest_zone FROM dated d JOIN hmap o ON d.unplug_station = o.station
             JOIN hmap p ON d.plug_station = p.station WHERE d.travel_time IS DISTINCT FROM 7)
, hcentroids AS (SELECT zone, avg(lat) AS lat, avg(lon) AS lon FROM stations WHERE station % 10 <> 3 GROUP BY zone)
"""
    q["lost_rows_null_zone"] = holes + """
SELECT CASE WHEN t.trip_date IS NULL THEN 'no_date' WHEN o.station IS NULL AND p.station IS NULL THEN 'no_origin_no_destination'
            WHEN o.station IS NULL THEN 'no_origin' WHEN p.station IS NULL THEN 'no_destination'
            ELSE 'kept' END AS reason, count(*) AS n_trips
FROM htrips t LEFT JOIN hmap o ON t.unplug_station = o.station LEFT JOIN hmap p ON t.plug_station = p.station
GROUP BY 1"""
    q["undated_trips"] = holes + """
SELECT trip_id, age_range, unplug_station, plug_station, 'no_date' AS reason FROM htrips WHERE trip_date IS NULL"""
    q["zone_balance_null_zone"] = (
        holes + BALANCE.replace("FROM zoned", "FROM hzoned")
        + f"SELECT {BALANCE_COLS} FROM b LEFT JOIN hcentroids ce USING (zone)"
    )
    q["zone_stats_null_zone_from_cube"] = (
        holes + _stats(None, "dayofweek", src="hzoned") + _stats_select(False).replace("JOIN centroids", "JOIN hcentroids")
    )
    q["trips_by_weekday_one_zone"] = BASE + f"""
SELECT dayofweek, count(*) FILTER (WHERE year = 1996) AS "1996", count(*) FILTER (WHERE year = 1998) AS "1998",
       {WEEKDAY_LIST}[dayofweek] AS weekday_name
FROM zoned WHERE origin_zone = 'NO WINTER' GROUP BY dayofweek
HAVING count(*) FILTER (WHERE year = 1996) > 0 AND count(*) FILTER (WHERE year = 1998) > 0"""
    chosen = "SELECT origin_zone FROM zoned GROUP BY origin_zone ORDER BY md5(origin_zone || '7'), origin_zone LIMIT 1"
    q["trips_by_weekday_random_zone"] = (
        BASE + f", zoned_k AS (SELECT * FROM zoned WHERE origin_zone IN ({chosen}))\n"
        + _pivot("dayofweek", inner=False, names=True)
    )
    q["zone_stats_two_years"] = (
        BASE + ", two_years AS (SELECT * FROM zoned WHERE year IN (1997, 1999))" + _stats(None, "dayofweek", src="two_years")
        + _stats_select(False)
    )
    q["zone_balance_one_year"] = (
        BASE + BALANCE + f"SELECT {BALANCE_COLS} FROM b LEFT JOIN centroids ce USING (zone) WHERE year = 2000"
    )
    q["od_listed_stations"] = BASE + """
SELECT unplug_station, dayofweek, plug_station, count(*) AS n_trips FROM dated
WHERE plug_station IN (1, 2, 3, 6, 8) GROUP BY ALL"""
    q["zone_trips_normalised_keys"] = BASE + """
, listed AS (SELECT s_suppkey AS station, n_name AS zone FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT o.zone AS origin_zone, p.zone AS dest_zone, count(*) AS n_trips
FROM trips t JOIN listed o ON t.unplug_station = o.station JOIN listed p ON t.plug_station = p.station GROUP BY 1, 2"""
    q["union_by_name"] = BASE + """
SELECT trip_id, age_range, strftime(trip_date, '%Y-%m-%d') AS trip_date,
       CASE WHEN year(trip_date) >= 1998 THEN trip_id * 2 END AS track
FROM trips"""
    q["result_sink"] = q["zone_balance"]
    points = """
WITH m AS (SELECT avg(p_size) AS mx, stddev_samp(p_size) AS sx, avg(p_retailprice) AS my, stddev_samp(p_retailprice) AS sy
           FROM part),
pts AS (SELECT p_partkey AS station, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER) AS g,
               (p_size - mx) / sx AS x, (p_retailprice - my) / sy AS y
        FROM part CROSS JOIN m)
"""
    q["standardised_points"] = points + "SELECT station, round(x, 6) AS x_std, round(y, 6) AS y_std FROM pts"
    # squared Euclidean silhouette: the mean squared distance of a point to a group from the group's sums
    q["silhouette_of_brands"] = points + """
, s AS (SELECT g, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS q FROM pts GROUP BY g),
dist AS (SELECT p.station, p.g AS own, s.g, s.n,
                x * x + y * y + s.q / s.n - 2 * (x * s.sx + y * s.sy) / s.n AS d
         FROM pts p CROSS JOIN s),
ab AS (SELECT station, max(CASE WHEN own = g THEN n END) AS n,
              max(CASE WHEN own = g AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> g THEN d END) AS b
       FROM dist GROUP BY station)
SELECT round(avg(CASE WHEN n = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6) AS silhouette
FROM ab"""
    parts = "WITH parts AS (SELECT p_partkey AS station, CAST(p_size AS DOUBLE) AS x, CAST(p_retailprice AS DOUBLE) AS y FROM part),"
    q["station_clusters"] = parts + _lloyd("parts", "4", 1, 100, 10) + "\nSELECT station, CAST(c AS INTEGER) AS cluster FROM a"
    q["silhouette_by_k"] = parts + _lloyd("parts", "2,3,4,5,6,7,8,9", 1, 100, 10) + """
, s AS (SELECT k, c, count(*) AS n, CAST(sum(x) AS DOUBLE) AS sx, CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(x * x + y * y) AS DOUBLE) AS q
        FROM a JOIN g USING (station) GROUP BY k, c),
dist AS (SELECT a.k, station, a.c AS own, s.c, s.n,
                CAST(x * x + y * y AS DOUBLE) + s.q / s.n - 2 * (x * s.sx + y * s.sy) / s.n AS d
         FROM a JOIN g USING (station) JOIN s ON a.k = s.k),
ab AS (SELECT k, station, max(CASE WHEN own = c AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN own <> c THEN d END) AS b
       FROM dist GROUP BY k, station)
SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END), 6) AS silhouette
FROM ab GROUP BY k"""
    # station coordinates are the supplier's balance and nation, one row a station
    q["cluster_od_counts"] = BASE + ", sp AS (SELECT station, lat AS x, lon AS y FROM stations)," + _lloyd("sp", "4", 1, 100, 10) + """
SELECT CAST(o.c AS INTEGER) AS origin_group, CAST(p.c AS INTEGER) AS dest_group, dayofweek, count(*) AS n_trips
FROM dated d JOIN a o ON d.unplug_station = o.station JOIN a p ON d.plug_station = p.station GROUP BY 1, 2, 3"""
    q["lost_rows_exact_keys"] = BASE + """
, exact AS (SELECT s_suppkey AS station FROM supplier WHERE s_suppkey % 7 <> 0)
SELECT CASE WHEN o.station IS NULL AND p.station IS NULL THEN 'no_origin_no_destination'
            WHEN o.station IS NULL THEN 'no_origin' WHEN p.station IS NULL THEN 'no_destination'
            ELSE 'kept' END AS reason, count(*) AS n_trips
FROM trips t LEFT JOIN exact o ON t.unplug_station = o.station LEFT JOIN exact p ON t.plug_station = p.station
GROUP BY 1"""
    q["union_dedupe"] = BASE + """
SELECT DISTINCT trip_id, user_type, age_range, travel_time, unplug_station, plug_station,
       strftime(trip_date, '%Y-%m-%d') AS trip_date
FROM trips"""
    q["hour_text"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%H:%M:%S.%g') AS time_text,
       CAST(hour(ts) AS INTEGER) AS hour
FROM events"""
    q["year_text"] = BASE + """
SELECT strftime(trip_date, '%Y') AS year_text, count(*) AS n_trips FROM trips GROUP BY 1"""
    q["json_load"] = BASE + """
SELECT CAST(trip_id AS VARCHAR) || '-' || CAST(age_range AS VARCHAR) AS trip_id, CAST(ascii(user_type) AS INTEGER) AS user_type,
       age_range, travel_time, unplug_station, plug_station, strftime(trip_date, '%Y-%m-%d') AS trip_date, trip_hour
FROM trips"""
    q["zone_stats_season_from_cube"] = q["zone_stats_season"]
    q["zone_balance_from_cube"] = q["zone_balance"]
    q["zone_balance_incremental"] = q["zone_balance"]
    q["usage_by_age_from_cube"] = q["usage_by_age"]
    q["above_average_share_from_cube"] = q["above_average_share"]
    q["travel_time_by_age_summary_from_cube"] = q["travel_time_by_age_summary"]
    q["load_counts"] = q["lost_rows"]
    q["rescued_track"] = BASE + """
SELECT CAST(trip_id AS VARCHAR) || '-' || CAST(age_range AS VARCHAR) AS trip_id,
       CASE WHEN year(trip_date) >= 1998 THEN 'late' ELSE 'early' END AS part,
       CASE WHEN year(trip_date) >= 1998 THEN unplug_station END AS track_from,
       CASE WHEN year(trip_date) >= 1998 THEN plug_station END AS track_to
FROM trips"""
    q["random_zone"] = BASE + """
SELECT origin_zone AS zone FROM zoned GROUP BY origin_zone ORDER BY md5(origin_zone || '7'), origin_zone LIMIT 1"""
    q["quarantine_load"] = """
SELECT 'clean' AS part, count(*) AS n_good, CAST(0 AS BIGINT) AS n_quarantined FROM lineitem
UNION ALL
SELECT 'damaged' AS part, CAST(0 AS BIGINT) AS n_good, count(*) AS n_quarantined FROM lineitem"""
    cols = ", ".join(f"('{c}', '{t}')" for c, t in DRIFT_COLUMNS.items())
    q["schema_drift"] = BASE + f"""
, cols(col, types) AS (VALUES {cols})
, lines AS (SELECT *, CASE WHEN year(trip_date) < 1998 THEN 'early' ELSE 'late' END AS part FROM trips)
, files AS (SELECT part, count(*) AS n_file_lines, count(travel_time) AS n_timed FROM lines GROUP BY part)
SELECT part, col AS "column", types, CASE WHEN col = 'travel_time' THEN n_timed ELSE n_file_lines END AS n_lines,
       n_file_lines, false AS in_every_file
FROM files CROSS JOIN cols WHERE col NOT LIKE 'track%' OR part = 'late'
UNION ALL
SELECT 'cut', '_corrupt_record', 'STRING', n_file_lines, n_file_lines, false FROM files WHERE part = 'late'"""
    q["csv_load"] = """
SELECT CASE WHEN s_suppkey % 7 = 0 THEN printf('%03d a', s_suppkey) ELSE CAST(s_suppkey AS VARCHAR) END AS station_key,
       s_suppkey AS station, n_name AS zone, r_name AS district, round(s_acctbal, 6) AS lat,
       round(CAST(s_nationkey AS DOUBLE), 6) AS lon, s_nationkey + 10 AS docks
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
    q["xml_load"] = """
SELECT s_name AS name, round(s_acctbal, 6) AS lat, round(CAST(s_nationkey AS DOUBLE), 6) AS lon FROM supplier"""
    q["kml_load"] = q["xml_load"]
    return q
