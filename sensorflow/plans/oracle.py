"""DuckDB twins of the named queries, over the same tables."""

from __future__ import annotations

from sensorflow.plans.fixtures import READINGS_SQL


def r6(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6"


AS_OF = "TIMESTAMP '2024-01-24 00:00:00'"
ENRICH_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
READING = f"reading_id, device_id, sensor_type, {r6('value')} AS value, unit, ts, quality, status"
RANGE = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"

VIEWS = {
    "readings": READINGS_SQL.format(events="events"),
    "history": f"SELECT * FROM readings WHERE ts < {AS_OF}",
    "scored": f"SELECT * FROM readings WHERE ts >= {AS_OF}",
    "dirty": """
SELECT reading_id, CASE WHEN reading_id % 31 = 0 THEN '' ELSE device_id END AS device_id,
 CASE WHEN reading_id % 37 <> 0 THEN sensor_type END AS sensor_type, value,
 CASE WHEN reading_id % 41 <> 0 THEN unit END AS unit, ts,
 CASE WHEN reading_id % 43 = 0 THEN latitude + 90 ELSE latitude END AS latitude, longitude, quality, status
FROM readings""",
    "checked": """
SELECT *, concat_ws('; ',
 CASE WHEN coalesce(device_id, '') = '' THEN 'device_id is required' END,
 CASE WHEN coalesce(sensor_type, '') = '' THEN 'sensor_type is required' END,
 CASE WHEN unit IS NULL THEN 'unit is required' END,
 CASE WHEN latitude < -90 OR latitude > 90 THEN 'latitude must be between -90 and 90' END,
 CASE WHEN longitude < -180 OR longitude > 180 THEN 'longitude must be between -180 and 180' END) AS errors
FROM dirty""",
    "versions": """
SELECT *, ts AS updated_at FROM readings
UNION ALL
SELECT reading_id, device_id, sensor_type, value + 1, unit, ts, latitude, longitude, 'Warning',
 CASE WHEN status = 'Active' THEN 'Active' ELSE 'Inactive' END, ts + INTERVAL 1 HOUR FROM readings""",
    "tied": """
SELECT * FROM versions
UNION ALL
SELECT * REPLACE (value + 1 AS value, 'Critical' AS quality) FROM versions WHERE updated_at > ts AND reading_id % 10 = 0""",
    "rich": """
SELECT *, CASE WHEN reading_id % 3 = 0 THEN CAST(reading_id % 500 AS DOUBLE) END AS altitude,
 CASE WHEN reading_id % 4 <> 0 THEN CAST(reading_id % 100 AS VARCHAR) END AS battery,
 CASE WHEN reading_id % 4 <> 0 THEN concat('x < ', reading_id) END AS note FROM readings""",
    "json_lines": """
SELECT reading_id, CAST(floor(value) AS DOUBLE) AS value, reading_id % 47 = 0 OR reading_id % 53 = 0 AS is_broken,
 concat('{"reading_id":"', reading_id, '","device_id":"', device_id, '","sensor_type":"', sensor_type, '","value":',
  CASE WHEN reading_id % 47 = 0 THEN '"high"' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, ',"unit":"', unit, '"',
  CASE WHEN reading_id % 53 = 0 THEN '' ELSE '}' END) AS line
FROM readings""",
    "csv_lines": """
SELECT reading_id, CAST(floor(value) AS DOUBLE) AS value, reading_id % 47 = 0 OR reading_id % 59 = 0 AS is_broken,
 concat(reading_id, ',', device_id, ',', sensor_type, ',',
  CASE WHEN reading_id % 47 = 0 THEN 'high' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, ',', unit, ',,',
  CASE WHEN reading_id % 59 = 0 THEN '{oops' ELSE '' END, ',,', quality, ',', status) AS line
FROM readings""",
    "changed_store": """
SELECT r.* REPLACE (CASE WHEN o_orderstatus = 'O' THEN value + 1 ELSE value END AS value,
  CASE WHEN o_orderstatus = 'O' THEN 'Warning' ELSE quality END AS quality,
  CASE WHEN o_orderstatus = 'O' AND status <> 'Active' THEN 'Inactive' ELSE status END AS status),
 CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '2024-01-24 00:00:00' END AS updated_at
FROM readings r LEFT JOIN orders ON o_orderkey = reading_id WHERE o_orderstatus IS DISTINCT FROM 'F'""",
    "tombstones": "SELECT o_orderkey AS reading_id FROM orders WHERE o_orderstatus = 'F'",
    "subscriptions": """
SELECT concat('device_dev_', c_custkey % 150) AS channel, concat('customer_', c_custkey) AS subscriber FROM customer
UNION ALL SELECT 'alerts', concat('desk_', n_nationkey) FROM nation
UNION ALL SELECT concat('sensor_', ['temperature', 'humidity', 'pressure', 'voltage', 'vibration'][n_nationkey % 5 + 1]),
 concat('lab_', n_nationkey) FROM nation WHERE n_nationkey < 8
UNION ALL SELECT 'all', concat('archive_', r_regionkey) FROM region""",
    "messages": """
SELECT reading_id,
 CASE WHEN reading_id % 40 = 0 THEN concat('other/', device_id, '/data')
      WHEN reading_id % 2 = 0 THEN concat('sensors/', device_id, '/data')
      ELSE concat('iot/', device_id, '/telemetry') END AS topic,
 CASE reading_id % 5
  WHEN 0 THEN concat('{"DeviceId":"', device_id, '","SensorType":"', sensor_type, '","Value":{"Value":', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ',"Unit":"', unit, '"}}')
  WHEN 1 THEN concat(' {"DeviceId":"","SensorType":"', sensor_type, '","Value":{"Value":', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ',"Unit":"', unit, '"}}')
  WHEN 2 THEN concat(sensor_type, ':', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), ',battery:', CAST(reading_id % 100 AS VARCHAR), ',bad')
  WHEN 3 THEN concat(sensor_type, ':abc')
  ELSE CASE WHEN reading_id % 10 = 4 THEN 'a:b:c' ELSE '{broken' END END AS payload,
 ts AS received_at
FROM readings""",
    "limits": """
SELECT * FROM (VALUES ('temperature', -40.0::DOUBLE, 85.0::DOUBLE, 50.0::DOUBLE, 0.1::DOUBLE),
 ('humidity', 0.0, 100.0, 30.0, 0.1), ('pressure', 300.0, 1100.0, 20.0, 0.1)) AS t(kind, lo, hi, pct, min_var)""",
    "seen": """
SELECT r.*, lag(value) OVER w AS prev_value,
 count(*) OVER (PARTITION BY device_id, sensor_type ORDER BY ts, reading_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS earlier,
 var_pop(value) OVER (PARTITION BY device_id, sensor_type ORDER BY ts, reading_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS variance10,
 lo, hi, coalesce(pct, 100.0::DOUBLE) AS pct, coalesce(min_var, 0.001::DOUBLE) AS min_var
FROM readings r LEFT JOIN limits ON lower(sensor_type) = kind
WINDOW w AS (PARTITION BY device_id, sensor_type ORDER BY ts, reading_id)""",
    "judged": """
SELECT *, CASE WHEN prev_value <> 0 THEN abs((value - prev_value) / prev_value * 100) END AS pct_change
FROM seen WHERE earlier >= 2""",
    "rolling": """
SELECT *, CASE
  WHEN value < lo OR value > hi THEN 'OutOfRange'
  WHEN pct_change > pct OR (prev_value = 0 AND value <> 0) THEN
   CASE WHEN value > prev_value THEN 'SuddenSpike' ELSE 'SuddenDrop' END
  WHEN earlier >= 10 AND variance10 < min_var THEN 'FlatLine' END AS type,
 CASE
  WHEN value < lo THEN least((lo - value) / (hi - lo), 1.0)
  WHEN value > hi THEN least((value - hi) / (hi - lo), 1.0)
  WHEN prev_value = 0 AND value <> 0 THEN 1.0
  WHEN pct_change > pct THEN least(pct_change / 100, 1.0)
  WHEN earlier >= 10 AND variance10 < min_var THEN 0.5 END AS severity
FROM judged""",
    "anomalies": """
SELECT sha256(concat_ws('|', CAST(reading_id AS VARCHAR), 'Rolling', type)) AS anomaly_id, device_id, sensor_type, type,
 CAST(severity AS DOUBLE) AS severity, ts AS detected_at, reading_id
FROM rolling WHERE type IS NOT NULL""",
    "cleaned": """
SELECT reading_id, device_id, sensor_type, unit, ts, quality, status, value AS raw,
 CASE WHEN lo IS NULL THEN value ELSE greatest(lo, least(hi, value)) END AS clamped, digits
FROM (SELECT *,
  CASE WHEN sensor_type LIKE '%temperature%' THEN -100.0::DOUBLE WHEN sensor_type LIKE '%humidity%' THEN 0.0
       WHEN sensor_type LIKE '%pressure%' THEN 0.0 WHEN sensor_type LIKE '%voltage%' THEN -50.0 END AS lo,
  CASE WHEN sensor_type LIKE '%temperature%' THEN 150.0::DOUBLE WHEN sensor_type LIKE '%humidity%' THEN 100.0
       WHEN sensor_type LIKE '%pressure%' THEN 2000.0 WHEN sensor_type LIKE '%voltage%' THEN 50.0 END AS hi,
  CASE WHEN sensor_type LIKE '%humidity%' OR sensor_type LIKE '%pressure%' THEN 10.0::DOUBLE
       WHEN sensor_type LIKE '%voltage%' THEN 1000.0 ELSE 100.0 END AS digits
 FROM readings)""",
    "clean": """
SELECT reading_id, device_id, sensor_type, unit, ts, quality, status, raw,
 round_even(clamped * digits, 0) / digits AS value FROM cleaned""",
    "zprofile": """
SELECT sensor_type, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS sd FROM history GROUP BY sensor_type""",
    "quartile_rows": """
SELECT sensor_type, value, row_number() OVER (PARTITION BY sensor_type ORDER BY value) - 1 AS rn,
 count(*) OVER (PARTITION BY sensor_type) AS n
FROM history WHERE ts >= TIMESTAMP '2024-01-17 00:00:00'""",
    "quartiles": """
SELECT sensor_type, max(n) AS n, max(value) FILTER (WHERE rn = floor(0.25 * n)) AS q1,
 max(value) FILTER (WHERE rn = floor(0.75 * n)) AS q3 FROM quartile_rows GROUP BY sensor_type""",
    "iqr": """
SELECT s.reading_id, s.device_id, s.sensor_type, s.value, coalesce(n, 0) AS n, q1, q3,
 q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi
FROM scored s LEFT JOIN quartiles USING (sensor_type)""",
    "iqr_found": f"""
SELECT reading_id, device_id, sensor_type,
 CASE WHEN n < 10 THEN 'NetworkTimeout' WHEN value < lo THEN 'SuddenDrop' WHEN value > hi THEN 'SuddenSpike'
      ELSE 'OutOfRange' END AS type,
 CASE WHEN n >= 10 AND (value < lo OR value > hi) THEN 0.8::DOUBLE ELSE 0.0 END AS severity,
 n >= 10 AND coalesce(value < lo OR value > hi, false) AS is_anomaly,
 'ThresholdAnomalyDetection_Dynamic' AS method,
 {r6("CASE WHEN n >= 10 THEN lo END")} AS lower, {r6("CASE WHEN n >= 10 THEN hi END")} AS upper,
 {r6("CASE WHEN n >= 10 THEN q1 END")} AS q1, {r6("CASE WHEN n >= 10 THEN q3 END")} AS q3,
 {r6("CASE WHEN n >= 10 THEN q3 - q1 END")} AS iqr, n AS history_count
FROM iqr""",
    "recent": f"""
SELECT sensor_type, value, row_number() OVER (PARTITION BY sensor_type ORDER BY ts, reading_id) AS rn,
 count(*) OVER (PARTITION BY sensor_type) AS n
FROM history WHERE ts >= {AS_OF} - INTERVAL 24 HOUR""",
    "ema": """
SELECT sensor_type, max(n) AS n,
 sum(value * CASE WHEN rn = 1 THEN pow(0.7::DOUBLE, n - 1) ELSE 0.3 * pow(0.7::DOUBLE, n - rn) END) AS ema
FROM recent GROUP BY sensor_type""",
    "slope": """
SELECT sensor_type, coalesce(regr_slope(value, CAST(rn AS DOUBLE)), 0.0) AS trend FROM recent WHERE rn > n - 10
GROUP BY sensor_type""",
    "expected": """
SELECT s.*, coalesce(n, 0) AS n, ema, trend, ema + trend AS expected,
 abs(value - (ema + trend)) / greatest(abs(ema + trend), 1.0) AS deviation
FROM scored s LEFT JOIN ema USING (sensor_type) LEFT JOIN slope USING (sensor_type)""",
    "trend_found": """
SELECT *, CASE WHEN n < 5 THEN 'NetworkTimeout' WHEN deviation > 0.3 THEN
  CASE WHEN value > expected THEN 'SuddenSpike' ELSE 'SuddenDrop' END END AS type,
 CASE WHEN n < 5 THEN 0.0::DOUBLE ELSE least(deviation / 0.3, 1.0) END AS severity
FROM expected""",
    "zscored": """
SELECT s.*, coalesce(n, 0) AS n, mean, sd, CASE WHEN sd <> 0 THEN abs((value - mean) / sd) END AS z
FROM scored s LEFT JOIN zprofile USING (sensor_type)""",
    "z_found": """
SELECT *, CASE WHEN n < 10 THEN 'NetworkTimeout' WHEN sd = 0 THEN 'FlatLine' WHEN z > 2.5 THEN
  CASE WHEN value > mean THEN 'SuddenSpike' ELSE 'SuddenDrop' END END AS type,
 CASE WHEN n < 10 OR sd = 0 THEN 0.0::DOUBLE ELSE least(z / 2.5, 1.0) END AS severity
FROM zscored""",
    "enriched": """
SELECT *, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 6e7 AS age,
 CASE WHEN sensor_type LIKE '%temperature%' THEN value >= -50 AND value <= 100
      WHEN sensor_type LIKE '%humidity%' THEN value >= 0 AND value <= 100
      WHEN sensor_type LIKE '%pressure%' THEN value >= 800 AND value <= 1200 ELSE true END AS in_range
FROM readings""",
    "quality": """
SELECT *, greatest(1.0::DOUBLE - CASE WHEN in_range THEN 0.0::DOUBLE ELSE 0.2 END
 - CASE WHEN age > 10 THEN 0.1::DOUBLE ELSE 0.0 END - CASE WHEN age > 60 THEN 0.2::DOUBLE ELSE 0.0 END, 0.0) AS score
FROM enriched""",
    "routes": """
SELECT reading_id, unnest(['all', concat('device_', device_id), concat('sensor_', sensor_type)]) AS channel,
 unnest(['SensorDataReceived', 'DeviceDataReceived', 'SensorTypeDataReceived']) AS event FROM readings""",
    "alert_routes": """
SELECT reading_id, unnest(['all', concat('device_', device_id), 'alerts']) AS channel,
 unnest(['AnomalyDetected', 'DeviceAnomalyDetected', 'AlertReceived']) AS event FROM anomalies""",
    "subscribed": """
SELECT * FROM messages WHERE regexp_matches(topic, '^sensors/[^/]+/data$') OR regexp_matches(topic, '^iot/[^/]+/telemetry$')""",
    "changed": """
SELECT *, lag(value) OVER w AS old_value, lag(unit) OVER w AS old_unit, lag(quality) OVER w AS old_quality,
 lag(status) OVER w AS old_status, row_number() OVER w AS seq
FROM tied WINDOW w AS (PARTITION BY reading_id ORDER BY updated_at, value)""",
    "event_rows": """
SELECT 'SensorDataCreated' AS event_type, * FROM changed WHERE seq = 1
UNION ALL SELECT 'SensorValueUpdated', * FROM changed WHERE seq > 1
UNION ALL SELECT 'SensorQualityChanged', * FROM changed WHERE seq > 1 AND old_quality IS DISTINCT FROM quality
UNION ALL SELECT 'SensorLocationUpdated', * FROM changed
UNION ALL SELECT 'SensorStatusChanged', * FROM changed WHERE seq > 1 AND old_status IS DISTINCT FROM status""",
    "metrics": """
SELECT date_trunc('millisecond', ts) AS ts, unnest(['SensorData Queue', 'Anomaly Queue']) AS metric,
 unnest([CAST(floor(value * 10) AS DOUBLE), CAST(event_id % 150 AS DOUBLE)]) AS value
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT date_trunc('millisecond', ts), unnest(['WorkingSetMB', 'CPUUsagePercent', 'AvailableMemoryMB', 'ThreadCount']),
 unnest([CAST(floor(value * 5) AS DOUBLE), CAST(event_id % 101 AS DOUBLE), CAST(floor(value * 4) AS DOUBLE),
  CAST(event_id % 130 AS DOUBLE)])
FROM events WHERE event_type NOT IN ('view', 'click')""",
}

# What each view reads, so that a query carries only the views it needs.
USES = {
    "history": ["readings"],
    "scored": ["readings"],
    "dirty": ["readings"],
    "checked": ["dirty"],
    "versions": ["readings"],
    "messages": ["readings"],
    "seen": ["readings", "limits"],
    "judged": ["seen"],
    "rolling": ["judged"],
    "anomalies": ["rolling"],
    "cleaned": ["readings"],
    "clean": ["cleaned"],
    "zprofile": ["history"],
    "quartile_rows": ["history"],
    "quartiles": ["quartile_rows"],
    "iqr": ["scored", "quartiles"],
    "iqr_found": ["iqr"],
    "recent": ["history"],
    "ema": ["recent"],
    "slope": ["recent"],
    "expected": ["scored", "ema", "slope"],
    "trend_found": ["expected"],
    "zscored": ["scored", "zprofile"],
    "z_found": ["zscored"],
    "enriched": ["readings"],
    "quality": ["enriched"],
    "routes": ["readings"],
    "alert_routes": ["anomalies"],
    "subscribed": ["messages"],
    "tied": ["versions"],
    "rich": ["readings"],
    "json_lines": ["readings"],
    "csv_lines": ["readings"],
    "changed_store": ["readings"],
    "changed": ["tied"],
    "event_rows": ["changed"],
}


def _with(uses: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for below in USES.get(name, []):
            add(below)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        add(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    return (f"WITH {head}\n" if head else "") + body.strip()


def _rate(source: str, ts: str, key: str = "") -> str:
    select, group = (f"{key}, ", f"{key}, ") if key else ("", "")
    return f"""
SELECT {select}window_start, count(*) AS events, {r6("count(*) / 300.0::DOUBLE")} AS per_second
FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, {ts}) - to_minutes(CAST(o AS INTEGER)) AS window_start
 FROM {source}, range(0, 5) AS t(o))
GROUP BY {group}window_start"""


FINDING = "reading_id, device_id, sensor_type, type"
ROUNDTRIP = f"""
SELECT reading_id, true AS same_id, true AS has_text, device_id, sensor_type, {r6("value")} AS value, unit, ts,
 {r6("latitude")} AS latitude, {r6("longitude")} AS longitude, altitude,
 CAST(CASE WHEN battery IS NULL THEN 0 ELSE 2 END AS BIGINT) AS metadata_count, battery, note, quality, status FROM rich"""

CHANGED_STORE = f"SELECT {READING}, updated_at, false AS is_deleted FROM changed_store"

ROLLING = f"""
SELECT {FINDING}, {r6("severity")} AS severity, true AS is_anomaly, 'Rolling' AS method, ts, {r6("value")} AS value,
 {r6("prev_value")} AS prev_value, {r6("pct_change")} AS pct_change,
 {r6("CASE WHEN type = 'FlatLine' THEN variance10 END")} AS variance10
FROM rolling WHERE type IS NOT NULL"""

ZSCORE = f"""
SELECT {FINDING}, {r6("severity")} AS severity, severity > 0 AS is_anomaly, 'StatisticalAnomalyDetection' AS method,
 {r6("CASE WHEN n >= 10 THEN z END")} AS z_score, {r6("CASE WHEN n >= 10 THEN mean END")} AS mean,
 {r6("CASE WHEN n >= 10 THEN sd END")} AS std_dev, n AS history_count, 2.5::DOUBLE AS threshold
FROM z_found WHERE type IS NOT NULL"""

PARSED = f"""
SELECT reading_id, split_part(topic, '/', 2) AS device_id,
 CASE WHEN reading_id % 5 IN (0, 1) THEN payload::JSON->>'$.SensorType'
      WHEN reading_id % 5 IN (2, 3) THEN split_part(payload, ':', 1)
      WHEN payload = 'a:b:c' THEN 'unknown' END AS sensor_type,
 {r6("CASE WHEN reading_id % 5 IN (0, 1) THEN CAST(payload::JSON->>'$.Value.Value' AS DOUBLE) WHEN reading_id % 5 IN (2, 3) THEN coalesce(try_cast(split_part(split_part(payload, ',', 1), ':', 2) AS DOUBLE), 0.0) WHEN payload = 'a:b:c' THEN 0.0 END")} AS value,
 CASE WHEN reading_id % 5 IN (0, 1) THEN payload::JSON->>'$.Value.Unit'
      WHEN reading_id % 5 IN (2, 3) THEN 'unit' WHEN payload = 'a:b:c' THEN 'unknown' END AS unit,
 received_at AS ts,
 CASE WHEN reading_id % 5 = 2 THEN CAST(reading_id % 100 AS VARCHAR) END AS battery,
 CAST(CASE WHEN reading_id % 5 = 2 THEN 1 ELSE 0 END AS BIGINT) AS metadata_count,
 payload = '{{broken' AS is_broken
FROM subscribed"""

QUERIES: dict[str, tuple[list[str], str]] = {
    "rolling_anomalies": (["rolling"], ROLLING),
    "rolling_anomalies_stream": (["rolling"], ROLLING),
    "rolling_anomalies_shuffled_stream": (["rolling"], ROLLING),
    "anomaly_triage": (
        ["rolling"],
        f"""
SELECT {FINDING}, {r6("severity")} AS severity,
 CASE WHEN severity >= 0.8 THEN 'critical' WHEN severity >= 0.6 THEN 'high' WHEN severity >= 0.4 THEN 'medium'
      WHEN severity >= 0.2 THEN 'low' ELSE 'none' END AS level
FROM rolling WHERE type IS NOT NULL""",
    ),
    "zscore_anomalies": (["z_found"], ZSCORE),
    "scored_stream": (["z_found"], ZSCORE),
    "threshold_anomalies": (
        ["scored"],
        f"""
SELECT reading_id, device_id, sensor_type, CASE WHEN value < lo THEN 'SuddenDrop' ELSE 'SuddenSpike' END AS type,
 {r6("CASE WHEN value < lo THEN CASE WHEN lo = 0 THEN 1.0 ELSE least((lo - value) / abs(lo), 1.0) END ELSE least((value - hi) / hi, 1.0) END")} AS severity,
 true AS is_anomaly, 'ThresholdAnomalyDetection' AS method, lo AS min, hi AS max, value < lo AS is_below, value > hi AS is_above
FROM scored JOIN (VALUES ('temperature', -40.0::DOUBLE, 80.0::DOUBLE), ('humidity', 0, 100), ('pressure', 800, 1200),
 ('voltage', 0, 12), ('current', 0, 10), ('ph', 0, 14), ('co2', 350, 5000)) AS b(kind, lo, hi) ON lower(sensor_type) = kind
WHERE value < lo OR value > hi""",
    ),
    "iqr_anomalies": (["iqr_found"], "SELECT * FROM iqr_found WHERE sensor_type = 'vibration'"),
    "iqr_all_types": (["iqr_found"], "SELECT * FROM iqr_found"),
    "ema_trend_anomalies": (
        ["trend_found"],
        f"""
SELECT {FINDING}, {r6("severity")} AS severity, severity > 0 AS is_anomaly, 'TimeSeriesAnomalyDetection' AS method,
 {r6("CASE WHEN n >= 5 THEN ema END")} AS ema, {r6("CASE WHEN n >= 5 THEN trend END")} AS trend,
 {r6("CASE WHEN n >= 5 THEN expected END")} AS expected, {r6("CASE WHEN n >= 5 THEN deviation END")} AS deviation,
 n AS history_count
FROM trend_found WHERE type IS NOT NULL""",
    ),
    "routed_anomalies": (
        ["trend_found", "z_found"],
        f"""
SELECT {FINDING}, {r6("severity")} AS severity, severity > 0 AS is_anomaly, 'TimeSeriesAnomalyDetection' AS method,
 'timeseries' AS detector
FROM trend_found WHERE type IS NOT NULL AND sensor_type IN ('temperature', 'humidity', 'pressure')
UNION ALL
SELECT {FINDING}, {r6("severity")}, severity > 0, 'StatisticalAnomalyDetection', 'statistical'
FROM z_found WHERE type IS NOT NULL AND sensor_type NOT IN ('temperature', 'humidity', 'pressure')""",
    ),
    "detector_compatibility": (
        ["readings"],
        """
SELECT DISTINCT sensor_type, d AS detector FROM readings, (VALUES ('statistical'), ('threshold'), ('timeseries')) AS t(d)
WHERE d <> 'timeseries' OR regexp_matches(sensor_type, 'temperature|humidity|pressure|flow|voltage|current')""",
    ),
    "validate_readings": (
        ["checked"],
        f"SELECT {READING}, {ENRICH_AS_OF} AS processed_at FROM checked WHERE errors = ''",
    ),
    "dead_letters": (["checked"], "SELECT reading_id, ts, errors FROM checked WHERE errors <> ''"),
    "clean_readings": (["clean"], f"SELECT {READING} FROM clean"),
    "enrich_readings": (
        ["quality"],
        f"""
SELECT reading_id, {r6("value")} AS value, in_range AS in_expected_range,
 {r6("CASE WHEN sensor_type LIKE '%temperature%' AND unit = 'celsius' THEN value * 9 / 5 + 32 END")} AS temperature_f,
 {r6("CASE WHEN sensor_type LIKE '%temperature%' AND unit = 'celsius' THEN value + 273.15 END")} AS temperature_k,
 {r6("CASE WHEN sensor_type LIKE '%pressure%' AND unit = 'hpa' THEN value * 0.0145038 END")} AS pressure_psi,
 {r6("CASE WHEN sensor_type LIKE '%pressure%' AND unit = 'hpa' THEN value * 0.02953 END")} AS pressure_inhg,
 hour(ts) AS hour_of_day, dayname(ts) AS day_of_week, dayofweek(ts) IN (0, 6) AS is_weekend,
 {r6("score")} AS quality_score,
 CASE WHEN score >= 0.9 THEN 'Excellent' WHEN score >= 0.7 THEN 'Good' WHEN score >= 0.5 THEN 'Fair'
      WHEN score >= 0.3 THEN 'Poor' ELSE 'Critical' END AS quality_level,
 {r6("age")} AS data_age_minutes, age < 5 AS is_fresh
FROM quality""",
    ),
    "processing_trace": (
        ["clean"],
        f"""
SELECT reading_id, 'DataCleaning' AS step, 1::BIGINT AS priority, {r6("raw")} AS value_before, {r6("value")} AS value_after,
 0::BIGINT AS metadata_count FROM clean
UNION ALL
SELECT reading_id, 'DataEnrichment', 5::BIGINT, {r6("value")}, {r6("value")},
 CAST(CASE WHEN unit IN ('celsius', 'hpa') THEN 9 ELSE 7 END AS BIGINT) FROM clean""",
    ),
    "parse_messages": (["subscribed"], PARSED),
    "serialize_json": (
        ["readings"],
        f"""
SELECT reading_id, concat('{{"id":"', reading_id, '","deviceId":"', device_id, '","sensorType":"', sensor_type,
 '","value":{{#"unit":"', unit, '"}},"timestamp":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'),
 '","location":{{#}},"metadata":{{}},"quality":"', quality, '","status":"', status, '"}}') AS frame,
 {r6("value")} AS value, {r6("longitude")} AS longitude FROM readings""",
    ),
    "roundtrip_json": (["rich"], ROUNDTRIP),
    "roundtrip_xml": (["rich"], ROUNDTRIP),
    "reading_by_id": (["readings"], f"SELECT {READING} FROM readings WHERE reading_id = 321"),
    "readings_by_device": (["readings"], f"SELECT {READING} FROM readings WHERE device_id = 'dev_7' AND {RANGE}"),
    "readings_by_type": (["readings"], f"SELECT {READING} FROM readings WHERE sensor_type = 'temperature' AND {RANGE}"),
    "anomalies_by_device": (
        ["anomalies"],
        f"""
SELECT anomaly_id, reading_id, device_id, sensor_type, type, {r6("severity")} AS severity, detected_at
FROM anomalies WHERE device_id = 'dev_7' AND {RANGE.replace("ts", "detected_at")}""",
    ),
    "live_readings": (
        ["readings", "tombstones"],
        f"SELECT {READING} FROM readings r WHERE NOT EXISTS (SELECT 1 FROM tombstones t WHERE t.reading_id = r.reading_id)",
    ),
    "find_readings": (["readings"], f"SELECT {READING} FROM readings WHERE quality = 'Critical' AND value > 50"),
    "count_readings": (
        ["readings"],
        """
SELECT count(*) AS total, count(*) FILTER (WHERE sensor_type = 'humidity') AS matching,
 count(*) FILTER (WHERE sensor_type = 'humidity') > 0 AS any_match FROM readings""",
    ),
    "page_readings": (
        ["readings"],
        f"""
SELECT {READING} FROM (SELECT * FROM readings WHERE status = 'Active' ORDER BY value DESC, reading_id LIMIT 50 OFFSET 100)""",
    ),
    "current_readings": (
        ["versions"],
        f"""
SELECT {READING}, updated_at FROM versions
QUALIFY row_number() OVER (PARTITION BY reading_id ORDER BY updated_at DESC) = 1""",
    ),
    "high_value_readings": (["readings"], f"SELECT {READING} FROM readings WHERE value > 20"),
    "batch_summary": (
        ["readings"],
        f"""
SELECT 'total' AS item, count(*) AS n, NULL::BIGINT AS reading_id, NULL::DOUBLE AS value FROM readings
UNION ALL SELECT 'filtered', count(*), NULL, NULL FROM readings WHERE value > 20
UNION ALL SELECT 'sample', NULL, reading_id, {r6("value")} FROM (
 SELECT reading_id, value FROM readings WHERE value > 20 ORDER BY ts, reading_id LIMIT 5)""",
    ),
    "latest_readings": (
        ["readings"],
        f"""
SELECT {READING} FROM readings
QUALIFY row_number() OVER (PARTITION BY device_id, sensor_type ORDER BY ts DESC, reading_id DESC) = 1""",
    ),
    "latest_with_alert": (
        ["anomalies"],
        f"""
SELECT l.reading_id, l.device_id, l.sensor_type, {r6("l.value")} AS value, l.ts, alerted_at, alerted_at IS NOT NULL AS has_alert
FROM (SELECT * FROM readings WHERE ts <= {AS_OF}
 QUALIFY row_number() OVER (PARTITION BY device_id, sensor_type ORDER BY ts DESC, reading_id DESC) = 1) l
LEFT JOIN (SELECT device_id, sensor_type, max(detected_at) AS alerted_at FROM anomalies
 WHERE detected_at >= {AS_OF} - INTERVAL 6 HOUR AND detected_at <= {AS_OF} GROUP BY device_id, sensor_type) a
USING (device_id, sensor_type)""",
    ),
    "chart_series": (
        ["readings"],
        f"""
SELECT lower(sensor_type) AS series, reading_id, ts, {r6("value")} AS value FROM readings
WHERE lower(sensor_type) IN ('temperature', 'humidity')
QUALIFY row_number() OVER (PARTITION BY lower(sensor_type) ORDER BY ts DESC, reading_id DESC) <= 50""",
    ),
    "recent_anomalies": (
        ["anomalies"],
        """
SELECT reading_id, device_id, sensor_type, type, detected_at, CAST(floor(severity * 100 + 0.5) AS BIGINT) AS severity_percent
FROM anomalies ORDER BY detected_at DESC, reading_id DESC LIMIT 10""",
    ),
    "recent_activity": (
        ["anomalies"],
        """
SELECT ts, level, reading_id, device_id FROM (
 SELECT ts, 'info' AS level, reading_id, device_id FROM readings
 UNION ALL SELECT detected_at, 'warning', reading_id, device_id FROM anomalies)
ORDER BY ts DESC, level DESC, reading_id DESC LIMIT 100""",
    ),
    "sensor_profile": (
        ["readings"],
        f"""
SELECT sensor_type, count(*) AS n, {r6("avg(value)")} AS mean, {r6("var_pop(value)")} AS variance,
 {r6("stddev_pop(value)")} AS std_dev, {r6("min(value)")} AS lowest, {r6("max(value)")} AS highest
FROM readings GROUP BY sensor_type""",
    ),
    "sensor_quartiles": (
        ["readings"],
        f"""
SELECT sensor_type, max(n) AS n, {r6("max(value) FILTER (WHERE rn = floor(0.25 * n))")} AS q1,
 {r6("max(value) FILTER (WHERE rn = floor(0.75 * n))")} AS q3,
 {r6("max(value) FILTER (WHERE rn = floor(0.75 * n)) - max(value) FILTER (WHERE rn = floor(0.25 * n))")} AS iqr
FROM (SELECT sensor_type, value, row_number() OVER (PARTITION BY sensor_type ORDER BY value) - 1 AS rn,
 count(*) OVER (PARTITION BY sensor_type) AS n FROM readings) GROUP BY sensor_type""",
    ),
    "sensor_ema": (["ema"], f"SELECT sensor_type, n AS history_count, {r6('ema')} AS ema FROM ema"),
    "sensor_trend": (["slope"], f"SELECT sensor_type, {r6('trend')} AS trend FROM slope"),
    "reading_rate": (["readings"], _rate("readings", "ts")),
    "anomaly_rate": (["anomalies"], _rate("anomalies", "detected_at", "type")),
    "message_rate": (["subscribed"], _rate("subscribed", "received_at")),
    "change_events": (
        ["event_rows"],
        f"""
SELECT sha256(concat_ws('|', CAST(reading_id AS VARCHAR), event_type, CAST(epoch_us(updated_at) AS VARCHAR), CAST(seq AS VARCHAR))) AS event_id,
 event_type, 1::BIGINT AS version, seq AS sequence, status AS source, reading_id, device_id, updated_at AS occurred_on,
 {r6("CASE WHEN event_type = 'SensorValueUpdated' THEN old_value END")} AS old_value,
 {r6("CASE WHEN event_type IN ('SensorDataCreated', 'SensorValueUpdated') THEN value END")} AS new_value,
 CASE WHEN event_type = 'SensorValueUpdated' THEN old_unit END AS old_unit,
 CASE WHEN event_type IN ('SensorDataCreated', 'SensorValueUpdated') THEN unit END AS new_unit,
 CASE WHEN event_type = 'SensorQualityChanged' THEN old_quality END AS old_quality,
 CASE WHEN event_type = 'SensorQualityChanged' THEN quality END AS new_quality,
 CASE WHEN event_type = 'SensorStatusChanged' THEN old_status END AS old_status,
 CASE WHEN event_type = 'SensorStatusChanged' THEN status END AS new_status,
 {r6("CASE WHEN event_type = 'SensorLocationUpdated' THEN latitude END")} AS latitude,
 {r6("CASE WHEN event_type = 'SensorLocationUpdated' THEN longitude END")} AS longitude
FROM event_rows""",
    ),
    "quality_transitions": (
        ["readings"],
        """
SELECT reading_id, device_id, sensor_type, ts, quality AS new_quality, old_quality FROM (
 SELECT *, lag(quality) OVER (PARTITION BY device_id, sensor_type ORDER BY ts, reading_id) AS old_quality FROM readings)
WHERE old_quality <> quality""",
    ),
    "route_readings": (["routes"], "SELECT * FROM routes"),
    "route_anomalies": (["alert_routes"], "SELECT * FROM alert_routes"),
    "deliveries": (
        ["routes", "alert_routes", "subscriptions"],
        """
SELECT m.channel, reading_id, event, subscriber
FROM (SELECT * FROM routes UNION ALL SELECT * FROM alert_routes) m JOIN subscriptions s ON m.channel = s.channel""",
    ),
    "to_envelopes": (
        ["readings"],
        f"""
SELECT reading_id, concat('sensors/', device_id, '/data') AS topic, device_id, sensor_type, {r6("value")} AS value, unit,
 ts AS sent_at, {r6("latitude")} AS latitude,
 CAST(CASE quality WHEN 'Good' THEN 1 WHEN 'Warning' THEN 2 WHEN 'Critical' THEN 3 ELSE 4 END AS BIGINT) AS quality_code,
 CAST(CASE status WHEN 'Active' THEN 1 WHEN 'Maintenance' THEN 3 ELSE 4 END AS BIGINT) AS status_code
FROM readings""",
    ),
    "anomaly_envelopes": (
        ["anomalies"],
        f"""
SELECT reading_id, concat('alerts/', device_id, '/anomaly') AS topic, device_id, sensor_type, type,
 {r6("severity")} AS severity FROM anomalies""",
    ),
    "backlog_alerts": (
        ["metrics"],
        """
SELECT ts, metric, value, CASE WHEN metric = 'SensorData Queue' THEN 1000.0::DOUBLE ELSE 100.0 END AS threshold
FROM metrics WHERE (metric = 'SensorData Queue' AND value > 1000) OR (metric = 'Anomaly Queue' AND value > 100)""",
    ),
    "resource_alerts": (
        ["metrics"],
        """
SELECT ts, metric, value, CASE metric WHEN 'WorkingSetMB' THEN 1000.0::DOUBLE WHEN 'CPUUsagePercent' THEN 80.0
 WHEN 'AvailableMemoryMB' THEN 500.0 ELSE 100.0 END AS threshold
FROM metrics WHERE (metric = 'WorkingSetMB' AND value > 1000) OR (metric = 'CPUUsagePercent' AND value > 80)
 OR (metric = 'AvailableMemoryMB' AND value < 500) OR (metric = 'ThreadCount' AND value > 100)""",
    ),
    "ingest_stream": (
        ["subscribed"],
        f"""
SELECT reading_id, device_id, sensor_type, value, unit, ts FROM ({PARSED}) WHERE NOT is_broken""",
    ),
    "stored_once": (
        ["subscribed"],
        f"""
SELECT reading_id, device_id, sensor_type, value, unit, ts FROM ({PARSED}) WHERE NOT is_broken""",
    ),
    "stored_current_readings": (["changed_store"], CHANGED_STORE),
    "compacted_readings": (["changed_store"], CHANGED_STORE),
    "file_dead_letters": (
        ["json_lines", "csv_lines"],
        f"""
SELECT 'json' AS format, CASE WHEN NOT is_broken THEN reading_id END AS reading_id,
 CASE WHEN NOT is_broken THEN value END AS value, CASE WHEN is_broken THEN line END AS line FROM json_lines
UNION ALL SELECT 'csv', CASE WHEN NOT is_broken THEN reading_id END, CASE WHEN NOT is_broken THEN value END,
 CASE WHEN is_broken THEN line END FROM csv_lines""",
    ),
    "written_files": (
        ["rich"],
        f"""
SELECT format, {READING}, {r6("latitude")} AS latitude, altitude, battery, note FROM rich, (VALUES ('json'), ('csv')) AS f(format)""",
    ),
    "alert_hold_stream": (
        ["anomalies"],
        """
SELECT r.reading_id, count(*) AS alerts, max(detected_at) AS alerted_at FROM readings r JOIN anomalies a
ON r.device_id = a.device_id AND r.sensor_type = a.sensor_type AND detected_at <= ts AND detected_at >= ts - INTERVAL 6 HOUR
GROUP BY r.reading_id""",
    ),
    "reading_rate_stream": (
        ["readings"],
        f"""
SELECT * FROM ({_rate("readings", "ts")}) WHERE window_start + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM readings)""",
    ),
}


QUERIES["daily_profiles"] = QUERIES["sensor_profile"]


def oracle_sql() -> dict[str, str]:
    return {name: _with(uses, body) for name, (uses, body) in QUERIES.items()}
