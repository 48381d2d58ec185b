"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code from the definitions in README/SURVEY: the adapter
mapping of ``sensorlake/plans/adapters.py`` is restated here as SQL, and each product is the plain
SQL formulation (windows with ROW_NUMBER, COUNT(DISTINCT), direct joins) rather than the
aggregate-first plans the Spark side uses. Tables ``events customer nation lineitem ...`` are views.
"""

from __future__ import annotations

# --- adapter: bronze inputs -------------------------------------------------------------------

_EV = """
ev AS (
  SELECT *,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'view' THEN 'P1' WHEN 'click' THEN 'P2'
              WHEN 'purchase' THEN 'temperature' WHEN 'signup' THEN 'humidity'
              WHEN 'error' THEN 'pressure' END AS metric
  FROM events
)"""

_LIVE_RAW = """
live_pre AS (
  SELECT *,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
         CASE WHEN k = 13 THEN 'unknown' WHEN k = 29 THEN 'NaN'
              WHEN k = 31 AND event_type = 'error' THEN 'Infinity'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value_text
  FROM ev
),
live_raw AS (
  SELECT '0' AS _source_partition,
         CAST(event_id AS VARCHAR) AS _source_offset,
         CAST(event_id AS VARCHAR) AS id,
         CASE WHEN k = 3 THEN '"' || ts_text || '"'
              WHEN k = 5 THEN '''' || ts_text || ''''
              WHEN k = 7 THEN 'n/a' ELSE ts_text END AS "timestamp",
         CAST(user_id AS VARCHAR) AS sensor_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'SDS011' ELSE 'BME280' END AS sensor_type,
         CAST(user_id // 2 AS VARCHAR) AS location_id,
         CASE WHEN k = 11 THEN 'NaN' WHEN k = 17 THEN NULL
              ELSE CAST(CAST(CAST(user_id AS DOUBLE) / 1000 + 50 AS DECIMAL(18,3)) AS VARCHAR) END AS latitude,
         CASE WHEN k = 19 THEN 'NaN'
              ELSE CAST(CAST(CAST(user_id AS DOUBLE) / 500 + 10 AS DECIMAL(18,3)) AS VARCHAR) END AS longitude,
         CASE WHEN k = 23 THEN 'ua' END AS country,
         CASE WHEN metric = 'P1' THEN value_text END AS "P1",
         CASE WHEN metric = 'P2' THEN value_text END AS "P2",
         CASE WHEN metric = 'temperature' THEN value_text END AS temperature,
         CASE WHEN metric = 'humidity' THEN value_text END AS humidity,
         CASE WHEN metric = 'pressure' THEN value_text END AS pressure,
         'sensor_live' AS _source,
         ts + INTERVAL 5 MINUTE AS _ingested_at
  FROM live_pre
)"""

_ARCHIVE_RAW = """
archive_raw AS (
  SELECT CAST(user_id AS VARCHAR) AS sensor_id,
         CASE WHEN event_type IN ('view', 'click') THEN 'SDS011' ELSE 'BME280' END AS sensor_type,
         CAST(user_id // 2 AS VARCHAR) AS location,
         CAST(CAST(CAST(user_id AS DOUBLE) / 1000 + 50 AS DECIMAL(18,3)) AS VARCHAR) AS lat,
         CASE WHEN k = 47 THEN 'NaN'
              ELSE CAST(CAST(CAST(user_id AS DOUBLE) / 500 + 10 AS DECIMAL(18,3)) AS VARCHAR) END AS lon,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp",
         CASE WHEN metric = 'P1' THEN a_text END AS "P1",
         CASE WHEN metric = 'P2' THEN a_text END AS "P2",
         CASE WHEN metric = 'temperature' THEN a_text END AS temperature,
         CASE WHEN metric = 'humidity' THEN a_text END AS humidity,
         CASE WHEN metric = 'pressure' THEN a_text END AS pressure,
         'sensor_archive' AS _source,
         'archive/date=' || CAST(CAST(ts AS DATE) AS VARCHAR) || '/' || CAST(user_id AS VARCHAR) || '.csv'
             AS _source_file_name,
         ts + INTERVAL 1 DAY AS _ingested_at
  FROM (SELECT *,
               CASE WHEN k = 41 THEN 'unknown' WHEN k = 43 THEN 'NaN'
                    ELSE CAST(CAST(value * 2 AS DECIMAL(18,2)) AS VARCHAR) END AS a_text
        FROM ev)
)"""

_API_RECORDS = """
api_records AS (
  SELECT c.c_custkey AS api_pos,
         CAST(c.c_custkey // 2 AS VARCHAR) AS sensor_id,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'SDS011' WHEN 'BUILDING' THEN 'SDS011'
              WHEN 'FURNITURE' THEN 'BME280' WHEN 'HOUSEHOLD' THEN 'BME280'
              WHEN 'MACHINERY' THEN 'DHT22' END AS sensor_type,
         CAST(c.c_custkey // 4 AS VARCHAR) AS location_id,
         CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS lat,
         CAST(CAST(c.c_acctbal * 2 AS DECIMAL(18,2)) AS VARCHAR) AS lon,
         n.n_name AS country,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN '0' WHEN 'BUILDING' THEN '1'
              WHEN 'FURNITURE' THEN NULL WHEN 'HOUSEHOLD' THEN '0'
              WHEN 'MACHINERY' THEN '0' END AS indoor
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_REGISTRY_RAW = """
registry_raw AS (
  SELECT sensor_id, sensor_type, location_id, lat, lon, country, indoor,
         'registry_api' AS _source, 'api_response' AS _source_file_name,
         TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id ORDER BY api_pos) AS rn
        FROM api_records
        WHERE sensor_id IS NOT NULL AND sensor_type IN ('SDS011', 'BME280'))
  WHERE rn = 1
)"""

# --- silver -----------------------------------------------------------------------------------

_LONG = """
live_long AS (
  SELECT sensor_id, "timestamp", location_id, latitude, longitude, country, _source, _ingested_at,
         value_type, TRY_CAST(raw AS DOUBLE) AS value
  FROM (SELECT *, 'P1' AS value_type, "P1" AS raw FROM live_raw
        UNION ALL SELECT *, 'P2', "P2" FROM live_raw
        UNION ALL SELECT *, 'temperature', temperature FROM live_raw
        UNION ALL SELECT *, 'humidity', humidity FROM live_raw
        UNION ALL SELECT *, 'pressure', pressure FROM live_raw)
  WHERE raw IS NOT NULL AND TRY_CAST(raw AS DOUBLE) IS NOT NULL
),
archive_long AS (
  SELECT sensor_id, "timestamp", location AS location_id, lat AS latitude, lon AS longitude,
         CAST(NULL AS VARCHAR) AS country, _source, _ingested_at,
         value_type, TRY_CAST(raw AS DOUBLE) AS value
  FROM (SELECT *, 'P1' AS value_type, "P1" AS raw FROM archive_raw
        UNION ALL SELECT *, 'P2', "P2" FROM archive_raw
        UNION ALL SELECT *, 'temperature', temperature FROM archive_raw
        UNION ALL SELECT *, 'humidity', humidity FROM archive_raw
        UNION ALL SELECT *, 'pressure', pressure FROM archive_raw)
  WHERE raw IS NOT NULL AND TRY_CAST(raw AS DOUBLE) IS NOT NULL
),
long_readings AS (
  SELECT * FROM live_long UNION ALL SELECT * FROM archive_long
)"""

_CLEAN = """
clean_readings AS (
  SELECT * FROM (
    SELECT sensor_id,
           TRY_CAST(replace(replace("timestamp", '''', ''), '"', '') AS TIMESTAMP) AS event_ts_utc,
           value_type, value, location_id,
           TRY_CAST(latitude AS DOUBLE) AS latitude,
           TRY_CAST(longitude AS DOUBLE) AS longitude,
           upper(country) AS country, _source, _ingested_at
    FROM long_readings)
  WHERE value IS NOT NULL AND NOT isnan(value)
    AND (latitude IS NULL OR NOT isnan(latitude))
    AND (longitude IS NULL OR NOT isnan(longitude))
)"""

_READINGS = """
readings AS (
  SELECT sensor_id, event_ts_utc, value_type, value, location_id, latitude, longitude, country,
         _source, _ingested_at
  FROM (SELECT *, ROW_NUMBER() OVER (
                    PARTITION BY sensor_id, event_ts_utc, value_type
                    ORDER BY _ingested_at DESC NULLS LAST, _source DESC NULLS LAST,
                             value DESC NULLS LAST, location_id DESC NULLS LAST,
                             latitude DESC NULLS LAST, longitude DESC NULLS LAST,
                             country DESC NULLS LAST) AS rn
        FROM clean_readings)
  WHERE rn = 1
)"""

_LATEST_LIVE = """
latest_live AS (
  SELECT sensor_id, latitude, longitude, country
  FROM live_raw WHERE sensor_id IS NOT NULL
  QUALIFY ROW_NUMBER() OVER (
            PARTITION BY sensor_id
            ORDER BY "timestamp" DESC NULLS LAST, _source_partition DESC NULLS LAST,
                     TRY_CAST(_source_offset AS BIGINT) DESC NULLS LAST,
                     latitude DESC NULLS LAST, longitude DESC NULLS LAST,
                     country DESC NULLS LAST) = 1
)"""


def _devices(registry):
    return f"""
  SELECT reg.sensor_id, reg.sensor_type, reg.location_id,
         upper(ifnull(pos.country, reg.country)) AS country,
         TRY_CAST(ifnull(pos.latitude, reg.lat) AS DOUBLE) AS lat,
         TRY_CAST(ifnull(pos.longitude, reg.lon) AS DOUBLE) AS lon,
         TRY_CAST(reg.indoor AS BOOLEAN) AS indoor, reg._source, reg._ingested_at
  FROM {registry} reg LEFT JOIN latest_live pos USING (sensor_id)"""


_DEVICES = "devices AS (" + _devices("registry_raw") + "\n)"

SILVER = ("WITH " + ",".join([_EV, _LIVE_RAW, _ARCHIVE_RAW, _API_RECORDS, _REGISTRY_RAW, _LONG,
                              _CLEAN, _READINGS, _LATEST_LIVE, _DEVICES]) + "\n")

# --- gold -------------------------------------------------------------------------------------

# A sensor is outdoors unless its registry row says indoors; readings that belong to outdoor
# sensors, placed in the country of the device.
_PLACED = """,
outdoors AS (SELECT sensor_id, country FROM devices WHERE indoor IS NOT TRUE),
placed AS (
  SELECT o.country, r.value_type, r.value, date_trunc('hour', r.event_ts_utc) AS hour,
         CAST(r.event_ts_utc AS DATE) AS day
  FROM outdoors o, readings r WHERE o.sensor_id = r.sensor_id
)
"""
_MEAN = "round(sum(value) / count(value) + 1e-9, 6)"

AIR_QUALITY_HOURLY = SILVER.rstrip() + _PLACED + f"""
SELECT hour, country, value_type, count(value) AS n_readings, {_MEAN} AS avg_value,
       max(value) AS max_value, min(value) AS min_value
FROM placed GROUP BY ALL
"""

AIR_QUALITY_DAILY = SILVER.rstrip() + _PLACED + f"""
SELECT day, country, value_type, count(value) AS n_readings, {_MEAN} AS avg_value
FROM placed GROUP BY ALL
"""

SENSOR_NETWORK_HEALTH = SILVER.rstrip() + """,
seen AS (
  SELECT sensor_id, value_type, max(event_ts_utc) AS newest FROM readings GROUP BY ALL
)
SELECT country, count(DISTINCT value_type) AS distinct_metrics_seen, max(newest) AS last_seen,
       count(DISTINCT sensor_id) AS active_sensors
FROM seen JOIN devices USING (sensor_id) GROUP BY country
"""

# The limits as a relation: a reading above its metric's limit carries the limit's name. A sensor
# that no device row calls indoor counts as outdoors, registered or not.
ANOMALIES = SILVER.rstrip() + """,
limits(value_type, most, flag) AS (
  VALUES ('P1', 50.0, 'PM10_EXCEEDS_WHO_DAILY'), ('P2', 25.0, 'PM2_5_EXCEEDS_WHO_DAILY')
),
inside AS (SELECT sensor_id FROM devices WHERE indoor)
SELECT r.sensor_id, r.event_ts_utc, r.value_type, r.value, r.location_id,
       ifnull((SELECT country FROM devices d WHERE d.sensor_id = r.sensor_id), r.country)
           AS country,
       if(r.value > l.most, l.flag, NULL) AS anomaly_flag
FROM readings r JOIN limits l USING (value_type)
WHERE r.value IS NOT NULL AND r.sensor_id NOT IN (SELECT sensor_id FROM inside)
"""

ANOMALY_BREACHES = "SELECT * FROM (" + ANOMALIES + ") a WHERE anomaly_flag IS NOT NULL"

SILVER_READINGS = SILVER + "SELECT * FROM readings"
SILVER_DEVICES = SILVER + "SELECT * FROM devices"
LATEST_LIVE = SILVER + "SELECT * FROM latest_live"
# The response with the odd records arrived first.
REGISTRY = "WITH " + _API_RECORDS + """
SELECT sensor_id, sensor_type, location_id, lat, lon, country, indoor,
       'registry_api' AS _source, 'api_response' AS _source_file_name,
       TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
FROM api_records
WHERE sensor_id IS NOT NULL AND sensor_type IN ('SDS011', 'BME280')
QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY 1 - api_pos % 2, api_pos) = 1
"""
UNION_LIVE_ARCHIVE = SILVER + "SELECT * FROM long_readings"


# --- reshaping and dedup on lineitem ------------------------------------------------------------

UNPIVOT_METRICS = """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS value_type, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)
WHERE value IS NOT NULL
"""

DEDUP_READINGS = """
WITH li AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS sensor_id,
         CAST(date_trunc('year', l_shipdate) AS TIMESTAMP) AS event_ts_utc,
         'line-' || CAST(l_linenumber AS VARCHAR) AS value_type,
         l_extendedprice AS value, CAST(l_partkey AS VARCHAR) AS location_id,
         l_discount AS latitude, l_tax AS longitude, l_returnflag AS country,
         l_linestatus AS _source, l_shipdate AS _ingested_at
  FROM lineitem)
SELECT sensor_id, event_ts_utc, value_type, value, location_id, latitude, longitude, country,
       _source, _ingested_at
FROM (SELECT *, ROW_NUMBER() OVER (
                  PARTITION BY sensor_id, event_ts_utc, value_type
                  ORDER BY _ingested_at DESC NULLS LAST, _source DESC NULLS LAST,
                           value DESC NULLS LAST, location_id DESC NULLS LAST,
                           latitude DESC NULLS LAST, longitude DESC NULLS LAST,
                           country DESC NULLS LAST) AS rn
      FROM li)
WHERE rn = 1
"""

# --- registry updates and upsert --------------------------------------------------------------

UPSERT_DEVICES = SILVER.rstrip() + """,
sup_registry AS (
  SELECT CAST(s.s_suppkey * 10 AS VARCHAR) AS sensor_id, 'SDS011' AS sensor_type,
         CAST(s.s_suppkey AS VARCHAR) AS location_id,
         CAST(CAST(s.s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS lat,
         CAST(CAST(s.s_acctbal * 2 AS DECIMAL(18,2)) AS VARCHAR) AS lon,
         lower(n.n_name) AS country,
         CASE WHEN s.s_acctbal < 0 THEN '1' ELSE '0' END AS indoor,
         'registry_api' AS _source, TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
sup_devices AS (""" + _devices("sup_registry") + """
)
SELECT * FROM devices d WHERE NOT EXISTS (SELECT 1 FROM sup_devices u WHERE u.sensor_id = d.sensor_id)
UNION ALL
SELECT * FROM sup_devices
"""

# --- nested records, messages -----------------------------------------------------------------

_EV_TEXT = _EV.rstrip() + """,
evt AS (
  SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
         CASE WHEN k = 13 THEN 'unknown' WHEN k = 29 THEN 'NaN'
              WHEN k = 31 AND event_type = 'error' THEN 'Infinity'
              ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS value_text
  FROM ev
),
flat AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts_text AS "timestamp",
         CASE WHEN k = 53 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS sensor_id,
         CASE WHEN k = 53 THEN NULL WHEN event_type IN ('view', 'click') THEN 'SDS011'
              ELSE 'BME280' END AS sensor_type,
         CAST(user_id // 2 AS VARCHAR) AS location_id,
         CAST(CAST(CAST(user_id AS DOUBLE) / 1000 + 50 AS DECIMAL(18,3)) AS VARCHAR) AS latitude,
         CAST(CAST(CAST(user_id AS DOUBLE) / 500 + 10 AS DECIMAL(18,3)) AS VARCHAR) AS longitude,
         CASE WHEN k = 23 THEN 'ua' END AS country,
         metric, k,
         CASE WHEN k = 37 THEN CAST(CAST(value * 3 AS DECIMAL(18,2)) AS VARCHAR)
              ELSE value_text END AS mval
  FROM evt
),
normalized AS (
  SELECT id, "timestamp", sensor_id, sensor_type, location_id, latitude, longitude, country,
         CASE WHEN metric = 'P1' THEN mval END AS "P1",
         CASE WHEN metric = 'P2' THEN mval END AS "P2",
         CASE WHEN metric = 'temperature' THEN mval END AS temperature,
         CASE WHEN metric = 'humidity' THEN mval END AS humidity,
         CASE WHEN metric = 'pressure' THEN mval END AS pressure,
         '{"noise":"' || k || '"}' AS _other
  FROM flat
)"""

NORMALIZE_RECORDS = "WITH " + _EV_TEXT + "\nSELECT * FROM normalized"

PUBLISH_EVENTS = "WITH " + _EV_TEXT + """
SELECT key, left(body, length(body) - 1) || ',' || substr(_other, 2) AS value
FROM (SELECT sensor_id AS key, _other,
       to_json({'id': id, 'timestamp': "timestamp", 'sensor_id': sensor_id,
                'sensor_type': sensor_type, 'location_id': location_id, 'latitude': latitude,
                'longitude': longitude, 'country': country, 'P1': "P1", 'P2': "P2",
                'temperature': temperature, 'humidity': humidity, 'pressure': pressure})::VARCHAR AS body
FROM normalized)
"""

PARSE_EVENTS = "WITH " + _EV.strip() + """,
env AS (
  SELECT event_id, k, metric,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents,
         CAST(user_id AS VARCHAR) AS uid
  FROM ev
)
SELECT '0' AS _source_partition, CAST(event_id AS VARCHAR) AS _source_offset,
       CASE WHEN k = 59 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN k = 59 THEN NULL ELSE ts_text END AS "timestamp",
       CASE WHEN k = 59 THEN NULL ELSE uid END AS sensor_id,
       CASE WHEN k = 59 THEN NULL ELSE 'SDS011' END AS sensor_type,
       CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS latitude,
       CAST(NULL AS VARCHAR) AS longitude, CAST(NULL AS VARCHAR) AS country,
       CASE WHEN k <> 59 AND metric = 'P1' THEN cents END AS "P1",
       CASE WHEN k <> 59 AND metric = 'P2' THEN cents END AS "P2",
       CASE WHEN k = 59 THEN NULL
            WHEN metric IN ('P1', 'P2') THEN '{"k":"' || CAST(k AS VARCHAR) || '"}'
            ELSE '{"' || metric || '":"' || cents || '","k":"' || CAST(k AS VARCHAR) || '"}'
       END AS _rescued_data,
       CASE WHEN k = 59 THEN 'not json {' END AS _corrupt_record,
       'sensor_live' AS _source
FROM env
"""

# --- archive file manifest --------------------------------------------------------------------

_LISTING = _EV.rstrip() + """,
lev AS (
  SELECT *, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS ymd,
         CASE WHEN event_type IN ('view', 'click') THEN 'SDS011'
              WHEN event_type IN ('purchase', 'signup') THEN 'BME280' ELSE 'DHT22' END AS stype
  FROM ev
),
lfiles AS (
  SELECT *, CASE WHEN k = 61 THEN ymd || '_' || stype || '_index.csv'
                 ELSE ymd || '_' || stype || '_sensor_' || CAST(user_id AS VARCHAR) || '.csv' END AS f1,
            ymd || '_' || stype || '_sensor_' || CAST(user_id AS VARCHAR) || '.txt' AS f2
  FROM lev
),
listings AS (
  SELECT day, event_id AS pos,
         '<tr><td><a href="' || f1 || '">' || f1 || '</a></td><td><a href="' || f2
           || '">notes</a></td></tr>' AS html
  FROM lfiles
),
landed AS (
  SELECT day, f1 AS file_name, max(CASE WHEN k = 67 THEN 0 ELSE 2048 END) AS length
  FROM lfiles WHERE k IN (67, 71) GROUP BY day, f1
),
links AS (
  SELECT day, pos, unnest(regexp_extract_all(html, 'href="([^"]+\\.csv)"', 1)) AS file_name,
         generate_subscripts(regexp_extract_all(html, 'href="([^"]+\\.csv)"', 1), 1) - 1 AS link_idx
  FROM listings
  WHERE day BETWEEN DATE '2024-01-04' AND DATE '2024-01-25'
),
typed AS (
  SELECT *, regexp_extract(file_name, '_sensor_(\\d+)\\.csv', 1) AS sensor_id
  FROM links
  WHERE contains(lower(file_name), '_sds011_') OR contains(lower(file_name), '_bme280_')
),
known_links AS (
  SELECT * FROM typed t
  WHERE t.sensor_id <> ''
    AND EXISTS (SELECT 1 FROM registry_raw r WHERE r.sensor_id = t.sensor_id)
),
first_links AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY day, file_name
                                              ORDER BY pos, link_idx) AS rn FROM known_links)
  WHERE rn = 1
)"""


def _manifest(cap):
    capped = "first_links" if cap is None else (
        "(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY day ORDER BY pos, link_idx, "
        f"file_name) AS n FROM first_links) WHERE n <= {cap})")
    return ("WITH " + ",".join([_API_RECORDS, _REGISTRY_RAW]) + "," + _LISTING + f"""
SELECT f.day, f.file_name, f.sensor_id,
       'archive/date=' || CAST(f.day AS VARCHAR) || '/' || f.file_name AS dest_path,
       CASE WHEN EXISTS (SELECT 1 FROM landed l WHERE l.day = f.day AND l.file_name = f.file_name
                         AND l.length > 0) THEN 'skip' ELSE 'download' END AS status
FROM {capped} f
""")


FILE_MANIFEST = _manifest(None)
FILE_MANIFEST_CAPPED = _manifest(25)

# --- dashboards ---------------------------------------------------------------------------------

TOP10_LOCATIONS = SILVER + """
SELECT location_id,
       round(avg(CASE WHEN value_type = 'P1' THEN value END) + 1e-9, 6) AS avg_pm10,
       round(avg(CASE WHEN value_type = 'P2' THEN value END) + 1e-9, 6) AS avg_pm25,
       count(*) AS n_readings
FROM readings WHERE value_type IN ('P1', 'P2')
GROUP BY location_id
ORDER BY avg(CASE WHEN value_type = 'P1' THEN value END) DESC NULLS LAST, location_id
LIMIT 10
"""

ACTIVE_BY_REGION = SILVER.rstrip() + """,
health AS (
  SELECT d.country, count(DISTINCT r.sensor_id) AS active_sensors, max(r.event_ts_utc) AS last_seen
  FROM readings r JOIN devices d ON r.sensor_id = d.sensor_id GROUP BY d.country
)
SELECT g.r_name AS region, CAST(sum(h.active_sensors) AS BIGINT) AS active_sensors,
       max(h.last_seen) AS last_seen,
       count(*) AS n_countries
FROM health h LEFT JOIN (SELECT n.n_name, r.r_name FROM nation n
                         LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) g
       ON h.country = g.n_name
GROUP BY g.r_name
"""

PM_HOURLY = SILVER + """
SELECT d.country, date_trunc('hour', r.event_ts_utc) AS hour, r.value_type,
       round(avg(r.value) + 1e-9, 6) AS avg_value, count(*) AS n_readings
FROM readings r JOIN devices d ON r.sensor_id = d.sensor_id
WHERE (d.indoor = FALSE OR d.indoor IS NULL) AND r.value_type IN ('P1', 'P2')
GROUP BY d.country, date_trunc('hour', r.event_ts_utc), r.value_type
"""

METRIC_FIRST_SEEN = SILVER + """
SELECT value_type, min(event_ts_utc) AS first_event_ts, min(_ingested_at) AS first_ingested_at,
       count(*) AS n_readings
FROM (SELECT TRY_CAST(replace(replace("timestamp", '''', ''), '"', '') AS TIMESTAMP) AS event_ts_utc,
             value_type, value, TRY_CAST(latitude AS DOUBLE) AS lat,
             TRY_CAST(longitude AS DOUBLE) AS lon, _ingested_at
      FROM live_long)
WHERE NOT isnan(value) AND (lat IS NULL OR NOT isnan(lat)) AND (lon IS NULL OR NOT isnan(lon))
GROUP BY value_type
"""

LIVE_ACTIVE_SENSORS = SILVER + """
SELECT date_trunc('hour', event_ts_utc) AS window_start,
       date_trunc('hour', event_ts_utc) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT sensor_id) AS active_sensors
FROM readings WHERE event_ts_utc IS NOT NULL
GROUP BY date_trunc('hour', event_ts_utc)
"""

LIVE_PM_TREND = SILVER + """
SELECT date_trunc('hour', event_ts_utc) AS window_start,
       date_trunc('hour', event_ts_utc) + INTERVAL 1 HOUR AS window_end,
       value_type, round(avg(value) + 1e-9, 6) AS avg_value, count(*) AS n_readings
FROM readings WHERE value_type IN ('P1', 'P2') AND event_ts_utc IS NOT NULL
GROUP BY date_trunc('hour', event_ts_utc), value_type
"""

LATEST_BY_SENSOR = SILVER + """
SELECT sensor_id, value_type, event_ts_utc, value, latitude, longitude,
       CASE WHEN value IS NULL THEN NULL
            WHEN value_type = 'P1' THEN CASE WHEN value <= 20 THEN 'good' WHEN value <= 50 THEN 'moderate'
                                             WHEN value <= 100 THEN 'poor' ELSE 'very_poor' END
            WHEN value_type = 'P2' THEN CASE WHEN value <= 10 THEN 'good' WHEN value <= 25 THEN 'moderate'
                                             WHEN value <= 50 THEN 'poor' ELSE 'very_poor' END
       END AS level
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id, value_type
                                   ORDER BY event_ts_utc DESC NULLS LAST, value DESC NULLS LAST,
                                            latitude DESC NULLS LAST, longitude DESC NULLS LAST) AS rn
      FROM readings WHERE value_type IN ('P1', 'P2'))
WHERE rn = 1
"""

STAGE_COUNTS = SILVER + """
SELECT 'live_raw' AS stage, count(*) AS n_rows FROM live_raw
UNION ALL SELECT 'archive_raw', count(*) FROM archive_raw
UNION ALL SELECT 'long_readings', count(*) FROM long_readings
UNION ALL SELECT 'clean_readings', count(*) FROM clean_readings
UNION ALL SELECT 'readings', count(*) FROM readings
UNION ALL SELECT 'devices', count(*) FROM devices
"""


def all_sql() -> dict[str, str]:
    return {
        "air_quality_daily": AIR_QUALITY_DAILY,
        "air_quality_hourly": AIR_QUALITY_HOURLY,
        "sensor_network_health": SENSOR_NETWORK_HEALTH,
        "anomalies": ANOMALIES,
        "anomaly_breaches": ANOMALY_BREACHES,
        "silver_readings": SILVER_READINGS,
        "silver_devices": SILVER_DEVICES,
        "latest_live_per_sensor": LATEST_LIVE,
        "registry_first_wins": REGISTRY,
        "devices_by_type": DEVICES_BY_TYPE,
        "union_live_archive": UNION_LIVE_ARCHIVE,
        "unpivot_metrics": UNPIVOT_METRICS,
        "dedup_readings": DEDUP_READINGS,
        "upsert_devices": UPSERT_DEVICES,
        "normalize_records": NORMALIZE_RECORDS,
        "publish_events": PUBLISH_EVENTS,
        "parse_events": PARSE_EVENTS,
        "file_manifest": FILE_MANIFEST,
        "file_manifest_capped": FILE_MANIFEST_CAPPED,
        "top10_locations": TOP10_LOCATIONS,
        "active_by_region": ACTIVE_BY_REGION,
        "pm_hourly": PM_HOURLY,
        "metric_first_seen": METRIC_FIRST_SEEN,
        "live_active_sensors": LIVE_ACTIVE_SENSORS,
        "live_pm_trend": LIVE_PM_TREND,
        "latest_by_sensor": LATEST_BY_SENSOR,
        "stage_counts": STAGE_COUNTS,
        "bronze_archive_stream": BRONZE_ARCHIVE_STREAM,
        "bronze_live_stream": BRONZE_LIVE_STREAM,
        "readings_incremental": READINGS_INCREMENTAL,
        "readings_full_rerun": READINGS_FULL_RERUN,
        "live_active_sensors_stream": LIVE_ACTIVE_SENSORS_STREAM,
        "anomalies_incremental": ANOMALIES,
        "live_pm_trend_stream": LIVE_PM_TREND_STREAM,
        "latest_by_sensor_stream": LATEST_BY_SENSOR_STREAM,
        "air_quality_daily_incremental": AIR_QUALITY_DAILY,
        "schema_evolution_timeline": SCHEMA_EVOLUTION_TIMELINE,
        "run_log": RUN_LOG,
    }

BRONZE_ARCHIVE_STREAM = "WITH " + _EV.strip() + "," + _ARCHIVE_RAW + """
SELECT sensor_id, sensor_type, location, lat, lon, "timestamp", "P1", "P2", temperature,
       humidity, pressure, date, _source, date AS source_day,
       CASE WHEN sensor_type = 'BME280' THEN 'loc "' || location || '"; sensor ' || sensor_id END
           AS note,
       CASE WHEN sensor_type = 'SDS011' AND date >= '2024-01-15'
            THEN CAST(length("timestamp") AS VARCHAR) END AS "durP1"
FROM (SELECT *, substr("timestamp", 1, 10) AS date FROM archive_raw)
"""

BRONZE_LIVE_STREAM = "WITH " + _EV.strip() + """,
env AS (
  SELECT event_id, k, metric, ts >= TIMESTAMP '2024-01-15 00:00:00' AS phase_b,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS cents,
         CAST(user_id AS VARCHAR) AS uid
  FROM ev
)
SELECT '0' AS _source_partition, CAST(event_id AS VARCHAR) AS _source_offset,
       CASE WHEN k = 59 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS id,
       CASE WHEN k = 59 THEN NULL ELSE ts_text END AS "timestamp",
       CASE WHEN k = 59 THEN NULL ELSE uid END AS sensor_id,
       CASE WHEN k = 59 THEN NULL ELSE 'SDS011' END AS sensor_type,
       CAST(NULL AS VARCHAR) AS location_id, CAST(NULL AS VARCHAR) AS latitude,
       CAST(NULL AS VARCHAR) AS longitude, CAST(NULL AS VARCHAR) AS country,
       CASE WHEN k <> 59 AND metric = 'P1' THEN cents END AS "P1",
       CASE WHEN k <> 59 AND metric = 'P2' THEN cents END AS "P2",
       CASE WHEN k <> 59 AND phase_b AND metric = 'temperature' THEN cents END AS temperature,
       CASE WHEN k <> 59 AND phase_b AND metric = 'humidity' THEN cents END AS humidity,
       CASE WHEN k <> 59 AND phase_b AND metric = 'pressure' THEN cents END AS pressure,
       CASE WHEN k = 59 THEN NULL
            WHEN metric IN ('P1', 'P2') OR phase_b THEN '{"k":"' || CAST(k AS VARCHAR) || '"}'
            ELSE '{"' || metric || '":"' || cents || '","k":"' || CAST(k AS VARCHAR) || '"}'
       END AS _rescued_data,
       CASE WHEN k = 59 THEN 'not json {' END AS _corrupt_record,
       'sensor_live' AS _source,
       CASE WHEN k = 59 THEN NULL ELSE CAST(TRY_CAST(ts_text AS TIMESTAMP) AS DATE) END AS _event_date
FROM env
"""


READINGS_INCREMENTAL = SILVER + "SELECT *, CAST(event_ts_utc AS DATE) AS event_date FROM readings"

_LIVE_CLEAN = SILVER.rstrip() + """,
live_clean AS (
  SELECT * FROM (
    SELECT sensor_id,
           TRY_CAST(replace(replace("timestamp", '''', ''), '"', '') AS TIMESTAMP) AS event_ts_utc,
           value_type, value, TRY_CAST(latitude AS DOUBLE) AS latitude,
           TRY_CAST(longitude AS DOUBLE) AS longitude
    FROM live_long)
  WHERE NOT isnan(value) AND (latitude IS NULL OR NOT isnan(latitude))
    AND (longitude IS NULL OR NOT isnan(longitude))
)
"""

LIVE_PM_TREND_STREAM = _LIVE_CLEAN + """
SELECT date_trunc('hour', event_ts_utc) AS window_start,
       date_trunc('hour', event_ts_utc) + INTERVAL 1 HOUR AS window_end,
       value_type, round(avg(value) + 1e-9, 6) AS avg_value, count(*) AS n_readings
FROM live_clean WHERE value_type IN ('P1', 'P2') AND event_ts_utc IS NOT NULL
GROUP BY date_trunc('hour', event_ts_utc), value_type
"""

LATEST_BY_SENSOR_STREAM = _LIVE_CLEAN + """
SELECT sensor_id, value_type, event_ts_utc, value, latitude, longitude,
       CASE WHEN value IS NULL THEN NULL
            WHEN value_type = 'P1' THEN CASE WHEN value <= 20 THEN 'good' WHEN value <= 50 THEN 'moderate'
                                             WHEN value <= 100 THEN 'poor' ELSE 'very_poor' END
            WHEN value_type = 'P2' THEN CASE WHEN value <= 10 THEN 'good' WHEN value <= 25 THEN 'moderate'
                                             WHEN value <= 50 THEN 'poor' ELSE 'very_poor' END
       END AS level
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY sensor_id, value_type
                                   ORDER BY event_ts_utc DESC NULLS LAST, value DESC,
                                            latitude DESC NULLS LAST, longitude DESC NULLS LAST) AS rn
      FROM live_clean WHERE value_type IN ('P1', 'P2'))
WHERE rn = 1
"""

LIVE_ACTIVE_SENSORS_STREAM = _LIVE_CLEAN + """
SELECT date_trunc('hour', event_ts_utc) AS window_start,
       date_trunc('hour', event_ts_utc) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT sensor_id) AS active_sensors
FROM live_clean WHERE event_ts_utc IS NOT NULL GROUP BY ALL
"""

# Only the events before the cut remain after the second full build.
READINGS_FULL_RERUN = READINGS_INCREMENTAL.replace(
    "  FROM events\n", "  FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'\n")

SCHEMA_EVOLUTION_TIMELINE = """
SELECT value_type, min(ts) AS first_event_ts, count(*) AS n_readings
FROM (
  SELECT value_type, TRY_CAST("timestamp" AS TIMESTAMP) AS ts
  FROM (SELECT "timestamp", 'P1' AS value_type, "P1" AS raw FROM (""" + BRONZE_LIVE_STREAM + """) b
        UNION ALL SELECT "timestamp", 'P2', "P2" FROM (""" + BRONZE_LIVE_STREAM + """) b
        UNION ALL SELECT "timestamp", 'temperature', temperature FROM (""" + BRONZE_LIVE_STREAM + """) b
        UNION ALL SELECT "timestamp", 'humidity', humidity FROM (""" + BRONZE_LIVE_STREAM + """) b
        UNION ALL SELECT "timestamp", 'pressure', pressure FROM (""" + BRONZE_LIVE_STREAM + """) b)
  WHERE raw IS NOT NULL AND TRY_CAST(raw AS DOUBLE) IS NOT NULL)
GROUP BY value_type
"""

DEVICES_BY_TYPE = SILVER + """
SELECT sensor_type, country, count(*) AS devices,
       sum(CASE WHEN coalesce(indoor, FALSE) THEN 0 ELSE 1 END)::BIGINT AS outdoors,
       max(lat) AS northmost
FROM devices GROUP BY ALL
"""

RUN_LOG = SILVER + """
SELECT 'silver_readings' AS job, 'succeeded' AS status, CAST(NULL AS BIGINT) AS rows_in,
       (SELECT count(*) FROM readings) AS rows_out, CAST(NULL AS VARCHAR) AS message
UNION ALL
SELECT 'silver_devices', 'succeeded', (SELECT count(*) FROM registry_raw),
       (SELECT count(*) FROM devices), CAST(NULL AS VARCHAR)
UNION ALL
SELECT 'sensor_archive_raw', 'succeeded', (SELECT count(*) FROM archive_raw),
       (SELECT count(*) FROM archive_raw), CAST(NULL AS VARCHAR)
UNION ALL
SELECT 'sensor_live_raw', 'succeeded', n, n, CAST(NULL AS VARCHAR)
FROM (SELECT count(*) AS n FROM ev WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')
"""
