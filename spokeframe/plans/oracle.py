"""DuckDB SQL for the registered queries, over the same test-data tables.

Named pieces are written as common table expressions; each query lists those it needs.
"""

# What preparation turns into nulls or leaves out.
DRIFT = """
    count(*) AS raw_rows,
    count(*) FILTER (try_strptime(start_date, '%d/%m/%Y %H:%M') IS NULL AND start_date IS NOT NULL)
        AS unreadable_starts,
    count(*) FILTER (try_strptime(end_date, '%d/%m/%Y %H:%M') IS NULL AND end_date IS NOT NULL)
        AS unreadable_ends,
    count(*) FILTER (start_date IS NULL) AS no_start,
    count(*) FILTER (start_station_id IS NULL AND start_station_name IS NULL) AS short_rows,
    count(*) FILTER (end_station_id IS NULL AND end_station_name IS NULL) AS no_end_station,
    count(*) FILTER (duration IS NULL) AS no_duration,
    count(*) FILTER (duration <= 0) AS no_time_passed
"""

PIECES = {
    # Two passes over lineitem and two lookups of the supplier, unlike the Spark side.
    "raw_trips": ("", """
        SELECT l_orderkey * 10 + l_linenumber AS rental_id,
               ((l_quantity - 1) * 180)::INTEGER AS duration,
               (l_partkey % (SELECT 97 + count(*) // 20 FROM part))::INTEGER AS bike_id,
               CASE WHEN bad THEN 'n/a'
                    ELSE strftime(st + to_seconds(((l_quantity - 1) * 180)::INTEGER),
                                  '%d/%m/%Y %H:%M') END AS end_date,
               CASE WHEN NOT nul THEN end_id END AS end_station_id,
               CASE WHEN NOT nul THEN e.s_name END AS end_station_name,
               CASE WHEN bad THEN 'n/a' ELSE strftime(st, '%d/%m/%Y %H:%M') END AS start_date,
               l_suppkey AS start_station_id,
               s.s_name AS start_station_name
        FROM (SELECT *,
                     l_shipdate + to_minutes(((l_orderkey * 37 + l_linenumber * 101) % 1440)::INTEGER)
                         AS st,
                     (l_partkey * 7 + l_linenumber)
                         % (SELECT (count(*) * 9) // 10 FROM supplier) AS end_id,
                     l_linenumber = 6 AND l_quantity = 50 AS bad,
                     l_linenumber = 7 AND l_quantity = 49 AS nul
              FROM lineitem) l
        LEFT JOIN supplier s ON s.s_suppkey = l_suppkey
        LEFT JOIN supplier e ON e.s_suppkey = end_id
    """),
    "delivered": ("raw_trips", """
        SELECT * FROM raw_trips
        UNION ALL
        SELECT * FROM raw_trips WHERE rental_id % 50 = 1
    """),
    "trips": ("delivered", """
        SELECT DISTINCT rental_id, duration, bike_id, end_station_id, end_station_name,
               start_station_id, start_station_name,
               start_ts, year(start_ts)::INTEGER AS start_year,
               month(start_ts)::INTEGER AS start_month, day(start_ts)::INTEGER AS start_day,
               (dayofweek(start_ts) + 1)::INTEGER AS start_day_of_week,
               hour(start_ts)::INTEGER AS start_hour,
               end_ts, year(end_ts)::INTEGER AS end_year, month(end_ts)::INTEGER AS end_month,
               day(end_ts)::INTEGER AS end_day,
               (dayofweek(end_ts) + 1)::INTEGER AS end_day_of_week,
               hour(end_ts)::INTEGER AS end_hour
        FROM (SELECT *, try_strptime(start_date, '%d/%m/%Y %H:%M') AS start_ts,
                     try_strptime(end_date, '%d/%m/%Y %H:%M') AS end_ts
              FROM delivered)
        WHERE duration > 0
    """),
    "typed": ("trips", """
        SELECT *, CASE WHEN start_station_name = end_station_name THEN 'Round Trip'
                       ELSE 'Point to Point' END AS trip_type
        FROM trips
    """),
    "listed": ("", """
        SELECT s_suppkey::INTEGER AS id, s_name AS name,
               51.45::DOUBLE + (s_suppkey * 37 % 100)::DOUBLE / 1000 AS latitude,
               -0.22::DOUBLE + (s_suppkey * 53 % 200)::DOUBLE / 1000 AS longitude,
               15 + s_suppkey % 30 AS num_docks, s_suppkey % 15 AS num_bikes,
               15 + s_suppkey % 30 - s_suppkey % 15 AS num_empty
        FROM supplier WHERE s_acctbal >= 0
    """),
    "cartesian": ("listed", """
        SELECT *, nu * cos(phi) * cos(lam) AS x, nu * cos(phi) * sin(lam) AS y,
               nu * (6356752.3142::DOUBLE / 6378137 * 6356752.3142 / 6378137) * sin(phi) AS z
        FROM (SELECT *, radians(latitude) AS phi, radians(longitude) AS lam,
                     6378137 / sqrt(1 - (1 - (6356752.3142::DOUBLE / 6378137) ** 2)
                                        * sin(radians(latitude)) ** 2) AS nu
              FROM listed)
    """),
    "shifted": ("cartesian", """
        SELECT * EXCLUDE (x, y, z, nu, phi, lam),
               -446.448 + s * x - rz * y + ry * z AS x,
               125.157 + rz * x + s * y - rx * z AS y,
               -542.060 - ry * x + rx * y + s * z AS z
        FROM cartesian, (SELECT 1 + 20.4894::DOUBLE / 1000000 AS s,
                                radians(-0.1502::DOUBLE / 3600) AS rx,
                                radians(-0.2470::DOUBLE / 3600) AS ry,
                                radians(-0.8421::DOUBLE / 3600) AS rz)
    """),
    "airy": ("shifted", """
        SELECT * EXCLUDE (x, y, z, theta, p, a, b), atan2(y, x) AS lam, a, b,
               atan2(z + (a * a / (b * b) - 1) * b * sin(theta) ** 3,
                     p - (1 - b * b / (a * a)) * a * cos(theta) ** 3) AS phi
        FROM (SELECT *, sqrt(x * x + y * y) AS p,
                     atan2(z * a, sqrt(x * x + y * y) * b) AS theta
              FROM shifted, (SELECT 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b))
    """),
    "series": ("airy", """
        SELECT *, radians(49) AS phi0, (a - b) / (a + b) AS n, lam - radians(-2) AS d,
               tan(phi) ** 2 AS t2, 0.9996012717::DOUBLE AS f0,
               a * 0.9996012717 / sqrt(1 - (1 - b * b / (a * a)) * sin(phi) ** 2) AS nu,
               a * 0.9996012717 * (b * b / (a * a))
                   / (1 - (1 - b * b / (a * a)) * sin(phi) ** 2) ** 1.5 AS rho
        FROM airy
    """),
    "bike_points": ("series", """
        SELECT id, name, latitude, longitude,
               round(400000 + d * nu * cos(phi)
                   + d ** 3 * nu / 6 * cos(phi) ** 3 * (nu / rho - t2)
                   + d ** 5 * nu / 120 * cos(phi) ** 5
                     * (5 - 18 * t2 + t2 ** 2 + 14 * (nu / rho - 1) - 58 * t2 * (nu / rho - 1)),
                   3) AS osgb_x,
               round(-100000
                   + b * f0 * ((1 + n + 5 * n ** 2 / 4 + 5 * n ** 3 / 4) * (phi - phi0)
                   - (3 * n + 3 * n ** 2 + 21 * n ** 3 / 8) * sin(phi - phi0) * cos(phi + phi0)
                   + (15 * n ** 2 / 8 + 15 * n ** 3 / 8) * sin(2 * (phi - phi0))
                     * cos(2 * (phi + phi0))
                   - 35 * n ** 3 / 24 * sin(3 * (phi - phi0)) * cos(3 * (phi + phi0)))
                   + d ** 2 * nu / 2 * sin(phi) * cos(phi)
                   + d ** 4 * nu / 24 * sin(phi) * cos(phi) ** 3 * (5 - t2 + 9 * (nu / rho - 1))
                   + d ** 6 * nu / 720 * sin(phi) * cos(phi) ** 5 * (61 - 58 * t2 + t2 ** 2),
                   3) AS osgb_y,
               num_docks, num_bikes, num_empty
        FROM series
    """),
    "counts": ("trips", """
        SELECT start_station_name, end_station_name, count(*) AS trip_count,
               sum(duration)::BIGINT AS duration
        FROM trips GROUP BY ALL
    """),
    "routes": ("counts", """
        SELECT * FROM counts ORDER BY trip_count DESC, start_station_name NULLS FIRST,
               end_station_name NULLS FIRST LIMIT 10
    """),
    "possible": ("listed", """
        SELECT a.name AS start_station_name, b.name AS end_station_name
        FROM listed a CROSS JOIN listed b
    """),
    "dead": ("possible trips", """
        SELECT * FROM possible p
        WHERE NOT EXISTS (FROM trips t WHERE t.start_station_name = p.start_station_name
                          AND t.end_station_name = p.end_station_name)
    """),
    "ranked_dead": ("listed trips", """
        SELECT a.name AS start_station_name, b.name AS end_station_name,
               row_number() OVER (ORDER BY a.name NULLS FIRST, a.id, b.name NULLS FIRST, b.id) - 1 AS rank
        FROM listed a CROSS JOIN listed b
        WHERE NOT EXISTS (FROM trips t WHERE t.start_station_name = a.name
                          AND t.end_station_name = b.name)
    """),
    "dead_pick": ("ranked_dead", """
        SELECT start_station_name, end_station_name FROM ranked_dead
        WHERE rank = floor(('0x' || substr(md5('0'), 1, 13))::BIGINT / 16.0::DOUBLE ** 13
                           * (SELECT count(*) FROM ranked_dead))
    """),
    "summary": ("listed counts dead", """
        SELECT stations, stations * stations AS possible_pairs, recorded_pairs,
               stations * stations - recorded_pairs AS unrecorded_estimate, dead_pairs
        FROM (SELECT (SELECT count(*) FROM listed) AS stations,
                     (SELECT count(*) FROM counts) AS recorded_pairs,
                     (SELECT count(*) FROM dead) AS dead_pairs)
    """),
    "monthly": ("trips", """
        SELECT count(DISTINCT bike_id) AS bike_count, count(*) AS trip_count,
               start_year, start_month, start_year || '-' || start_month AS month,
               strftime(make_date(start_year, start_month, 1), '%B %Y') AS month_label
        FROM trips GROUP BY start_year, start_month
    """),
    "daily": ("trips", """
        SELECT count(DISTINCT bike_id) AS bike_count, start_year, start_month, start_day
        FROM trips GROUP BY start_year, start_month, start_day
    """),
    "usage": ("daily monthly", """
        SELECT d.bike_count AS bikes_used, m.bike_count AS bikes_available,
               m.bike_count - d.bike_count AS unused_bikes,
               d.start_year, d.start_month, d.start_day
        FROM daily d JOIN monthly m
          ON d.start_year = m.start_year AND d.start_month = m.start_month
    """),
    "bike_days": ("trips", """
        SELECT sum(duration)::DOUBLE / 60 AS duration, count(*) AS trip_count,
               bike_id, start_year, start_month, start_day
        FROM trips GROUP BY bike_id, start_year, start_month, start_day
    """),
    "top_dated_days": ("bike_days", """
        SELECT * FROM bike_days WHERE start_year IS NOT NULL
        ORDER BY trip_count DESC, bike_id NULLS FIRST, start_year, start_month, start_day
        LIMIT 20
    """),
    "journeys": ("top_dated_days listed trips", """
        SELECT t.start_ts, t.start_station_name, t.end_ts, t.end_station_name, t.duration,
               a.latitude AS start_lat, a.longitude AS start_lon,
               b.latitude AS end_lat, b.longitude AS end_lon
        FROM trips t
        JOIN (SELECT * EXCLUDE (duration, trip_count) FROM top_dated_days
              ORDER BY md5(concat_ws('|', '0', bike_id, start_year, start_month, start_day)),
                       bike_id LIMIT 1) k
          ON t.bike_id = k.bike_id AND t.start_year = k.start_year
             AND t.start_month = k.start_month AND t.start_day = k.start_day
        JOIN listed a ON t.start_station_id = a.id
        JOIN listed b ON t.end_station_id = b.id
    """),
    "totals": ("trips", """
        SELECT start_station_id, count(*) AS trip_count, sum(duration)::BIGINT AS duration
        FROM trips GROUP BY start_station_id
    """),
    "by_type": ("typed", """
        SELECT trip_type, count(*) AS trip_count, sum(duration)::BIGINT AS duration
        FROM typed GROUP BY trip_type
    """),
    "short": ("typed", "SELECT trip_type, duration FROM typed WHERE duration < 7200"),
    "weather_text": ("", """
        SELECT printf('   %d  %2d  %s  %6.1f  %6s  %6.1f  %6.1f%s', y, m,
                      CASE WHEN m = 2 THEN printf('%6.1f*', t) ELSE printf('%6.1f', t) END,
                      t - 18, CASE WHEN m = 7 THEN '---' ELSE (n % 20)::VARCHAR END, r, n::DOUBLE,
                      CASE WHEN m % 2 = 0 THEN '#' ELSE '  Provisional' END) AS value
        FROM (SELECT year(o_orderdate) + 18 AS y, month(o_orderdate) AS m,
                     round(5 + avg(o_totalprice) / 20000, 1) AS t, count(*) AS n,
                     round(sum(o_totalprice) / 1000000, 1) AS r
              FROM orders GROUP BY 1, 2)
    """),
    "weather_fields": ("weather_text", r"""
        SELECT string_split(regexp_replace(regexp_extract(value,
                   '^\s+([0-9]+\s+[0-9]+(\s+[0-9.-]+){5})', 1), '\s+', ' ', 'g'), ' ') AS f
        FROM weather_text
        WHERE regexp_matches(value, '^\s+[0-9]+\s+[0-9]+(\s+[0-9.-]+){5}.*$')
    """),
    "weather": ("weather_fields", """
        SELECT f[1]::INTEGER AS year, f[2]::INTEGER AS month,
               try_cast(f[3] AS DOUBLE) AS maximum_temp, try_cast(f[4] AS DOUBLE) AS minimum_temp,
               try_cast(f[5] AS DOUBLE) AS days_of_air_frost,
               try_cast(f[6] AS DOUBLE) AS total_rainfall,
               try_cast(f[7] AS DOUBLE) AS total_sunshine
        FROM weather_fields
    """),
    "manifest": ("", """
        SELECT 'usage-stats/' || page_id || ' Journey Data.csv' AS key,
               page_id || '_Journey_Data.csv' AS file_name,
               'https://example.org/usage-stats/' || page_id || ' Journey Data.csv' AS url,
               url LIKE 'https:%' AS landed
        FROM pages WHERE NOT contains(url, '?')
    """),
    "places": ("dead listed", """
        SELECT d.*, a.longitude AS start_lon, a.latitude AS start_lat,
               b.longitude AS end_lon, b.latitude AS end_lat
        FROM dead d JOIN listed a ON a.name = d.start_station_name
                    JOIN listed b ON b.name = d.end_station_name
    """),
    "type_stats": ("short", """
        SELECT trip_type, count(*) AS n, min(duration)::DOUBLE AS low, max(duration)::DOUBLE AS high,
               quantile_cont(duration, 0.75) - quantile_cont(duration, 0.25) AS iqr,
               stddev_samp(duration) * count(*) ** -0.2 AS h
        FROM short GROUP BY trip_type
    """),
    "type_bins": ("type_stats", """
        SELECT *, (high - low) / bins AS width
        FROM (SELECT *, least(50, CASE WHEN iqr > 0
                  THEN ceil((high - low) / (2 * iqr * n ** (-1.0::DOUBLE / 3)))
                  ELSE floor(sqrt(n)) END)::INTEGER AS bins
              FROM type_stats)
    """),
}

# query -> (pieces it needs, SELECT)
SELECTS = {
    "read_trips_csv": ("delivered", """
        SELECT rental_id AS "Rental Id", duration AS "Duration", bike_id AS "Bike Id",
               end_date AS "End Date", end_station_id AS "EndStation Id",
               end_station_name AS "EndStation Name", start_date AS "Start Date",
               start_station_id AS "StartStation Id", start_station_name AS "StartStation Name"
        FROM delivered"""),
    "prepare_trips": ("trips", "SELECT * FROM trips"),
    "write_trips": ("trips", "SELECT * FROM trips"),
    "merge_trips": ("trips", "SELECT * FROM trips"),
    "drift_by_file": ("delivered", """
        SELECT CASE WHEN start_date = 'n/a' THEN 'unreadable' ELSE substr(start_date, 7, 4) END AS year,
        """ + DRIFT + " FROM delivered GROUP BY year"),
    "prepare_drift": ("delivered", f"SELECT {DRIFT} FROM delivered"),
    "trips": ("trips", "SELECT * FROM trips"),
    "register_views": ("trips listed", """
        SELECT b.id, b.name, count(*) AS trips_started, sum(t.duration)::BIGINT AS seconds
        FROM trips t JOIN listed b ON t.start_station_id = b.id GROUP BY b.id, b.name"""),
    "bike_points": ("bike_points", """
        SELECT (row_number() OVER (ORDER BY id) - 1)::INTEGER AS idx, * FROM bike_points"""),
    "bike_points_inferred": ("bike_points", """
        SELECT (row_number() OVER (ORDER BY id) - 1)::INTEGER AS idx, * REPLACE (
               num_docks::INTEGER AS num_docks, num_bikes::INTEGER AS num_bikes,
               num_empty::INTEGER AS num_empty)
        FROM bike_points"""),
    "stations_from_json": ("bike_points", "SELECT * FROM bike_points"),
    "stations_grid": ("bike_points", """
        SELECT id, name, osgb_x AS x, osgb_y AS y, 27700 AS srid FROM bike_points"""),
    "stations_by_name": ("bike_points routes", """
        SELECT * FROM bike_points
        WHERE name IN (SELECT start_station_name FROM routes)
           OR name IN (SELECT end_station_name FROM routes)"""),
    "weather_parse": ("weather", "SELECT * FROM weather"),
    "weather_parse_unsigned": ("weather", """
        SELECT * REPLACE (abs(minimum_temp) AS minimum_temp) FROM weather"""),
    "weather_monthly": ("weather", """
        SELECT *, strftime(make_date(year, month, 1), '%B %Y') AS month_label
        FROM weather WHERE year > 2014"""),
    "file_manifest": ("manifest", "SELECT key, file_name, url FROM manifest"),
    "manifest_new_files": ("manifest", """
        SELECT key, file_name, url FROM manifest WHERE NOT landed"""),
    "trips_with_type": ("typed", "SELECT * FROM typed"),
    "trips_by_year": ("trips", """
        SELECT start_year, count(*) AS cnt, count(*) / 1000 AS cnt_thousands
        FROM trips GROUP BY start_year"""),
    "trips_by_month": ("trips", """
        SELECT start_year, start_month, count(*) AS cnt, avg(duration) AS duration,
               count(*) / 1000 AS cnt_thousands
        FROM trips GROUP BY start_year, start_month"""),
    "trips_month_pivot": ("trips", "SELECT start_month, " + ", ".join(
        f'nullif(count(*) FILTER (start_year = {y}), 0) AS "{y}"' for y in range(1995, 2002)
    ) + " FROM trips WHERE start_year IS NOT NULL GROUP BY start_month"),
    "top_start_stations": ("trips", """
        SELECT start_station_name, count(*) AS cnt, count(*) / 1000 AS cnt_thousands
        FROM trips GROUP BY 1 ORDER BY cnt DESC, start_station_name NULLS FIRST LIMIT 10"""),
    "top_end_stations": ("trips", """
        SELECT end_station_name, count(*) AS cnt, count(*) / 1000 AS cnt_thousands
        FROM trips GROUP BY 1 ORDER BY cnt DESC, end_station_name NULLS FIRST LIMIT 10"""),
    "trip_counts": ("counts", "SELECT * FROM counts"),
    "top_trips": ("counts", """
        SELECT * FROM counts ORDER BY trip_count DESC, start_station_name NULLS FIRST,
               end_station_name NULLS FIRST LIMIT 10"""),
    "bottom_trips": ("counts", """
        SELECT * FROM counts ORDER BY trip_count, start_station_name NULLS FIRST,
               end_station_name NULLS FIRST LIMIT 10"""),
    "trip_type_totals": ("by_type", "SELECT * FROM by_type"),
    "trip_type_share": ("by_type", """
        SELECT trip_type,
               round(100 * trip_count / sum(trip_count) OVER (), 1)::DOUBLE AS trip_share,
               round(100 * duration / sum(duration) OVER (), 1)::DOUBLE AS duration_share
        FROM by_type"""),
    "monthly_bikes": ("monthly", "SELECT * FROM monthly"),
    "daily_bikes": ("daily", "SELECT * FROM daily"),
    "daily_usage": ("usage", "SELECT * FROM usage"),
    "utilisation": ("usage", """
        SELECT min(bikes_used) AS bikes_used_min, max(bikes_used) AS bikes_used_max,
               avg(bikes_used) AS bikes_used_avg, max(bikes_available) AS bikes_available,
               min(unused_bikes) AS unused_bikes_min, max(unused_bikes) AS unused_bikes_max,
               avg(unused_bikes) AS unused_bikes_avg, start_year, start_month,
               strftime(make_date(start_year, start_month, 1), '%B %Y') AS month_label
        FROM usage GROUP BY start_year, start_month"""),
    "busy_bikes": ("bike_days", "SELECT * FROM bike_days"),
    "top_bike_days": ("top_dated_days", "SELECT * FROM top_dated_days"),
    "pick_busy_bike": ("top_dated_days", """
        SELECT * FROM top_dated_days
        ORDER BY md5(concat_ws('|', '0', bike_id, start_year, start_month, start_day)),
                 bike_id NULLS FIRST, start_year NULLS FIRST LIMIT 1"""),
    "bike_journeys": ("journeys", "SELECT * FROM journeys"),
    "bike_journey_count": ("journeys", "SELECT count(start_ts) AS journeys FROM journeys"),
    "trip_count_hist": ("bike_days", """
        SELECT bin, round(low + bin * (high - low) / 20, 6) AS bin_start,
               round(low + (bin + 1) * (high - low) / 20, 6) AS bin_end, count(*) AS bike_days
        FROM (SELECT *, least(floor((trip_count - low) * 20 / (high - low)), 19)::INTEGER AS bin
              FROM bike_days, (SELECT min(trip_count)::DOUBLE AS low, max(trip_count)::DOUBLE AS high
                               FROM bike_days WHERE start_year IS NOT NULL)
              WHERE start_year IS NOT NULL)
        GROUP BY bin, low, high"""),
    "duration_hist": ("short type_bins", """
        SELECT trip_type, bins, bin, round(low + bin * width, 6) AS bin_start,
               round(width, 6) AS width, count(*) AS trips,
               round(count(*) / (n * width), 12) AS density
        FROM (SELECT *, least(floor((duration - low) * bins / (high - low)), bins - 1)::INTEGER
                        AS bin
              FROM short JOIN type_bins USING (trip_type))
        GROUP BY trip_type, bins, bin, low, width, n"""),
    "duration_hist_shown": ("short type_bins", """
        SELECT trip_type, bins, bin, round(low + bin * width, 6) AS bin_start,
               round(width, 6) AS width, count(*) AS trips,
               round(count(*) / (n * width), 12) AS density
        FROM (SELECT *, least(floor((duration - low) * bins / (high - low)), bins - 1)::INTEGER
                        AS bin
              FROM short JOIN type_bins USING (trip_type))
        WHERE bin >= 2 AND bin <= 11
        GROUP BY trip_type, bins, bin, low, width, n"""),
    "duration_density": ("short type_stats", """
        SELECT trip_type, seconds, round(seconds / 60)::INTEGER || 'min' AS label,
               round(sum(c * exp(-(((seconds - duration) / h) ** 2) / 2))
                     / (n * h * sqrt(2 * pi())), 12) AS density
        FROM (SELECT trip_type, duration, count(*) AS c FROM short GROUP BY ALL)
        JOIN type_stats USING (trip_type),
             (SELECT range::INTEGER AS seconds FROM range(0, 7201, 60))
        GROUP BY trip_type, seconds, n, h"""),
    "station_totals": ("totals", "SELECT * FROM totals"),
    "station_map": ("totals listed", """
        SELECT id, longitude, latitude, duration, trip_count,
               round((trip_count - min(trip_count) OVER ())
                     / (max(trip_count) OVER () - min(trip_count) OVER ()), 9) AS colour_value,
               printf('POINT (%.6f %.6f)', longitude, latitude) AS wkt,
               longitude AS point_lon, latitude AS point_lat
        FROM listed JOIN totals ON id = start_station_id"""),
    "possible_trips": ("possible", "SELECT * FROM possible"),
    "pair_matrix": ("possible counts", """
        SELECT p.start_station_name, p.end_station_name,
               coalesce(trip_count, 0) AS trip_count, coalesce(duration, 0) AS duration
        FROM possible p LEFT JOIN counts c
          ON p.start_station_name = c.start_station_name
             AND p.end_station_name = c.end_station_name"""),
    "dead_trips": ("dead", "SELECT * FROM dead"),
    # One draw in every hundred ranks.
    "dead_trips_sample": ("ranked_dead", """
        SELECT start_station_name, end_station_name
        FROM ranked_dead
        JOIN (SELECT floor((i + ('0x' || substr(md5('0|' || i), 1, 8))::BIGINT / 16.0::DOUBLE ** 8)
                           / 0.01::DOUBLE)::BIGINT AS rank
              FROM range((SELECT count(*) // 100 + 1 FROM ranked_dead)) t(i)) USING (rank)"""),
    "pick_dead_trip": ("dead_pick", "SELECT * FROM dead_pick"),
    "dead_trips_summary": ("summary", "SELECT * FROM summary"),
    "dead_trips_message": ("summary dead_pick", """
        SELECT CASE WHEN dead_pairs > 0
                 THEN format('{:,} of the {:,} pairs among {} stations are unridden, such as ',
                             dead_pairs, possible_pairs, stations)
                      || start_station_name || ' to ' || end_station_name || '.'
                 ELSE format('All {:,} pairs among {} stations have been ridden.',
                             possible_pairs, stations) END AS message
        FROM summary LEFT JOIN dead_pick ON true"""),
    "trip_lines": ("places", """
        SELECT *, printf('LINESTRING (%.6f %.6f, %.6f %.6f)', start_lon, start_lat, end_lon, end_lat)
                      AS wkt,
               printf('%.6f, %.6f', start_lat, start_lon) AS start_text,
               printf('%.6f, %.6f', end_lat, end_lon) AS end_text,
               start_lon AS line_lon1, start_lat AS line_lat1,
               end_lon AS line_lon2, end_lat AS line_lat2
        FROM places"""),
    "bike_journey_lines": ("journeys", """
        SELECT *, printf('LINESTRING (%.6f %.6f, %.6f %.6f)', start_lon, start_lat, end_lon, end_lat)
                      AS wkt,
               printf('%.6f, %.6f', start_lat, start_lon) AS start_text,
               printf('%.6f, %.6f', end_lat, end_lon) AS end_text,
               start_lon AS line_lon1, start_lat AS line_lat1,
               end_lon AS line_lon2, end_lat AS line_lat2
        FROM journeys"""),
    "preview": ("trips", """
        SELECT * FROM trips ORDER BY rental_id NULLS FIRST, duration NULLS FIRST,
               bike_id NULLS FIRST, end_station_id NULLS FIRST, start_ts NULLS FIRST LIMIT 10"""),
}


def _needed(names):
    """Pieces by name, each after those it is made from."""
    ordered = []
    for name in names.split():
        for piece in [*_needed(PIECES[name][0]), name]:
            if piece not in ordered:
                ordered.append(piece)
    return ordered


def oracle_sql():
    statements = {}
    for query, (names, select) in SELECTS.items():
        parts = ",\n".join(f"{piece} AS ({PIECES[piece][1]})" for piece in _needed(names))
        statements[query] = f"WITH {parts}\n{select}"
    return statements
