"""The registered queries as single SQL statements for another engine."""

from __future__ import annotations

import re

RAW = """
SELECT arrival_id,
       CAST(u AS VARCHAR) AS station_id,
       'Station ' || u AS station_name,
       CAST(43.001 + u % 5 + 0.003 * (u % 7) AS DOUBLE) AS latitude,
       CAST(-0.999 + u % 5 + 0.003 * (u % 4) AS DOUBLE) AS longitude,
       CAST(CASE WHEN t = 'error' AND v > 150 THEN -1 ELSE b END AS INTEGER) AS bikes_available,
       CAST(CASE WHEN t = 'view' AND v > 200 THEN NULL ELSE cap - b END AS INTEGER) AS free_slots,
       CASE WHEN arrival_id % 997 = 0 THEN 'not-a-timestamp'
            WHEN arrival_id % 3 = 0 THEN strftime(polled, '%Y-%m-%dT%H:%M:%S') || '+00:00Z'
            ELSE strftime(polled, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS "timestamp",
       'net_' || (u % 5) AS network_id,
       'city_' || (u % 5) AS city,
       'net_' || (u % 5) || ':' || u AS station_key,
       strftime(polled + to_seconds(arrival_id % 60), '%Y-%m-%dT%H:%M:%S') || 'Z' AS ingested_at
FROM (SELECT *, CAST(floor(v) AS BIGINT) % (cap + 1) AS b
      FROM (SELECT event_id AS arrival_id, user_id AS u, event_type AS t, value AS v,
                   CASE WHEN user_id % 37 = 0 THEN 0 WHEN user_id % 10 = 3 THEN 2
                        ELSE 8 + user_id % 15 END AS cap,
                   TIMESTAMP '2024-01-01 18:00:00'
                     + to_minutes(date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts))
                     AS polled
            FROM events))
"""

TYPED = """
SELECT * EXCLUDE ("timestamp", ingested_at),
       TRY_CAST(regexp_replace("timestamp", '([+]00:00)?Z$', '') AS TIMESTAMP)
         AS snapshot_timestamp,
       TRY_CAST(regexp_replace(ingested_at, 'Z$', '') AS TIMESTAMP) AS ingested_at
FROM raw
"""

VALID = """
SELECT arrival_id, station_key, network_id, city, station_id, station_name, latitude, longitude,
       bikes_available, free_slots, bikes_available + free_slots AS capacity,
       CASE WHEN bikes_available + free_slots > 0
            THEN CAST(bikes_available AS DOUBLE) / (bikes_available + free_slots)
            ELSE 0.0 END AS utilization_rate,
       printf('%.2f', round(latitude, 2)) || '_' || printf('%.2f', round(longitude, 2))
         AS zone_id,
       snapshot_timestamp, ingested_at,
       CAST(snapshot_timestamp AS DATE) AS event_date,
       CAST(hour(snapshot_timestamp) AS INTEGER) AS event_hour
FROM typed
WHERE snapshot_timestamp IS NOT NULL AND ingested_at IS NOT NULL
  AND bikes_available >= 0 AND free_slots >= 0
"""

# Named building blocks; a statement gets those it mentions, and those they mention.
BLOCKS = {
    "raw": RAW,
    "typed": TYPED,
    "valid": VALID,
    "arrived": """
        SELECT * EXCLUDE (nth)
        FROM (SELECT *, row_number() OVER (PARTITION BY station_key, snapshot_timestamp
                                           ORDER BY arrival_id) AS nth FROM valid)
        WHERE nth = 1""",
    "facts": "SELECT * EXCLUDE (arrival_id) FROM arrived",
    "latest": """
        SELECT f.* FROM facts f
        JOIN (SELECT station_key, max(snapshot_timestamp) AS newest FROM facts GROUP BY 1) n
          ON f.station_key = n.station_key AND f.snapshot_timestamp = n.newest""",
    "ranked": """
        SELECT *, CAST(dense_rank() OVER (ORDER BY utilization_rate DESC, bikes_available,
                                                   station_name) AS INTEGER) AS utilization_rank
        FROM latest""",
    "zones": """
        SELECT city, zone_id, max(snapshot_timestamp) AS snapshot_timestamp,
               avg(bikes_available) AS avg_bikes_available, avg(free_slots) AS avg_free_slots,
               avg(utilization_rate) AS avg_utilization_rate, count(*) AS station_count,
               avg(bikes_available) < 8 AS shortage_flag
        FROM latest GROUP BY city, zone_id""",
    "baseline": """
        SELECT city, avg(utilization_rate) AS city_availability_ratio
        FROM latest GROUP BY city""",
    "imbalance": """
        SELECT z.city, z.zone_id, z.snapshot_timestamp, z.avg_bikes_available, z.avg_capacity,
               z.ratio AS zone_availability_ratio, b.city_availability_ratio,
               z.ratio - b.city_availability_ratio AS imbalance_score
        FROM (SELECT city, zone_id, max(snapshot_timestamp) AS snapshot_timestamp,
                     avg(bikes_available) AS avg_bikes_available,
                     avg(capacity) AS avg_capacity, avg(utilization_rate) AS ratio
              FROM latest GROUP BY city, zone_id) z JOIN baseline b USING (city)""",
    "moves": """
        SELECT *, CAST(greatest(abs(coalesce(bikes_available - was_bikes, 0)),
                                abs(coalesce(free_slots - was_slots, 0))) AS DOUBLE)
                  AS usage_proxy
        FROM (SELECT *, lag(bikes_available) OVER station AS was_bikes,
                     lag(free_slots) OVER station AS was_slots
              FROM facts
              WINDOW station AS (PARTITION BY station_key ORDER BY snapshot_timestamp))""",
    "activity": """
        SELECT city, event_date AS usage_date, event_hour AS usage_hour,
               sum(usage_proxy) AS estimated_activity
        FROM moves GROUP BY 1, 2, 3""",
    "peaks": """
        SELECT *, CAST(dense_rank() OVER (PARTITION BY city, usage_date
                                          ORDER BY estimated_activity DESC, usage_hour)
                       AS INTEGER) AS peak_rank
        FROM activity""",
    "rolling": """
        SELECT *, avg(utilization_rate) OVER (
                 PARTITION BY station_key ORDER BY snapshot_timestamp
                 RANGE BETWEEN INTERVAL 15 MINUTE PRECEDING AND CURRENT ROW)
                 AS rolling_15m_utilization
        FROM facts""",
    "at_latest": """
        SELECT l.*, m.mean AS rolling_15m_utilization
        FROM latest l JOIN (
            SELECT f.station_key, avg(f.utilization_rate) AS mean
            FROM facts f JOIN latest n ON f.station_key = n.station_key
             AND f.snapshot_timestamp >= n.snapshot_timestamp - INTERVAL 15 MINUTE
            GROUP BY f.station_key) m USING (station_key)""",
    "critical": """
        SELECT station_key, city, station_id, station_name, snapshot_timestamp,
               bikes_available, free_slots, utilization_rate, rolling_15m_utilization,
               bikes_available = 0 AS is_empty,
               CASE WHEN bikes_available = 0 THEN 'empty-and-critical' ELSE 'critical' END
                 AS alert_level
        FROM at_latest
        WHERE bikes_available <= 2 AND rolling_15m_utilization >= 0.6""",
    "flags": """
        SELECT *, bikes_available = 0 AS empty_now,
               bikes_available <= 2 AND rolling_15m_utilization >= 0.6 AS critical_now
        FROM rolling""",
    "history": """
        SELECT station_key, city, station_id, station_name, snapshot_timestamp,
               'empty' AS alert_type, station_name || ' is empty' AS alert_message,
               bikes_available, free_slots, utilization_rate, ingested_at AS created_at
        FROM flags WHERE empty_now
        UNION ALL
        SELECT station_key, city, station_id, station_name, snapshot_timestamp,
               'critical', station_name || ' is critically constrained',
               bikes_available, free_slots, utilization_rate, ingested_at
        FROM flags WHERE critical_now""",
    "current_alerts": """
        SELECT station_key, city, station_id, station_name, snapshot_timestamp,
               'empty' AS alert_type, station_name || ' is empty' AS alert_message,
               bikes_available, free_slots, utilization_rate
        FROM latest WHERE bikes_available = 0
        UNION ALL
        SELECT station_key, city, station_id, station_name, snapshot_timestamp,
               'critical', station_name || ' is critically constrained',
               bikes_available, free_slots, utilization_rate
        FROM critical""",
    "refreshes": """
        SELECT DISTINCT date_trunc('hour', snapshot_timestamp) + INTERVAL 1 HOUR AS refreshed_at
        FROM facts""",
    "standing": """
        SELECT r.refreshed_at, f.station_key, max(f.snapshot_timestamp) AS snapshot_timestamp
        FROM refreshes r JOIN facts f ON f.snapshot_timestamp < r.refreshed_at
        GROUP BY 1, 2""",
    "metrics": """
        SELECT s.refreshed_at, max(f.snapshot_timestamp) AS latest_snapshot,
               count(*) AS total_stations, avg(f.utilization_rate) AS avg_utilization_rate,
               count(*) FILTER (WHERE f.empty_now) AS empty_stations,
               count(*) FILTER (WHERE f.critical_now) AS critical_station_count
        FROM standing s JOIN flags f USING (station_key, snapshot_timestamp)
        GROUP BY s.refreshed_at""",
    "deltas": """
        SELECT *,
               coalesce(total_stations - lag(total_stations) OVER o, 0)
                 AS delta_total_stations,
               coalesce(avg_utilization_rate - lag(avg_utilization_rate) OVER o, 0)
                 AS delta_avg_utilization_rate,
               coalesce(empty_stations - lag(empty_stations) OVER o, 0)
                 AS delta_empty_stations,
               coalesce(critical_station_count - lag(critical_station_count) OVER o, 0)
                 AS delta_critical_station_count,
               latest_snapshot IS DISTINCT FROM lag(latest_snapshot) OVER o AS snapshot_changed
        FROM metrics WINDOW o AS (ORDER BY refreshed_at)""",
    "catalog": """
        SELECT s_suppkey AS position, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name,
               '/v2/networks/' || s_suppkey AS href, n_name AS city, r_name AS country
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "wishes": """
        SELECT * FROM (VALUES ('nation_1'), ('NATION_3'), (' Nation_8 '), ('nowhere'))
          AS w(requested_city)""",
    "hits": """
        SELECT w.requested_city, c.*,
               CASE WHEN lower(trim(c.city)) = lower(trim(w.requested_city)) THEN 0 ELSE 1 END
                 AS score
        FROM catalog c JOIN wishes w
          ON contains(lower(trim(c.city)), lower(trim(w.requested_city)))
          OR contains(lower(trim(w.requested_city)), lower(trim(c.city)))
        WHERE c.country IN ('AMERICA', 'EUROPE')""",
    "half": "SELECT max(event_id) AS newest FROM events",
}


def statement(sql: str) -> str:
    """``sql`` with the building blocks it needs as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    blocks = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in needed)
    return f"WITH {blocks}\n{sql}" if needed else sql


_FACT = """station_key, network_id, city, station_id, station_name, latitude, longitude,
 bikes_available, free_slots, capacity, round(utilization_rate, 6) AS utilization_rate, zone_id,
 snapshot_timestamp, ingested_at, event_date, event_hour"""
_SHOWN = """city, station_name, latitude, longitude, bikes_available, free_slots, capacity,
 round(utilization_rate, 6) AS utilization_rate, zone_id, snapshot_timestamp, ingested_at"""
_ALERT = """station_key, city, station_id, station_name, snapshot_timestamp, alert_type,
 alert_message, bikes_available, free_slots, round(utilization_rate, 6) AS utilization_rate"""
_TRANSITIONS = f"""
        SELECT {_ALERT} FROM history JOIN (
          SELECT station_key, snapshot_timestamp,
                 lag(empty_now) OVER o AS empty_before,
                 lag(critical_now) OVER o AS critical_before
          FROM flags WINDOW o AS (PARTITION BY station_key ORDER BY snapshot_timestamp)) p
        USING (station_key, snapshot_timestamp)
        WHERE NOT coalesce(CASE alert_type WHEN 'empty' THEN empty_before
                           ELSE critical_before END, false)"""
_RANKED = """station_key, network_id, city, station_id, station_name, latitude, longitude,
 bikes_available, free_slots, capacity, round(utilization_rate, 6) AS utilization_rate, zone_id,
 snapshot_timestamp, utilization_rank"""
_TOP = """city, station_name, bikes_available, free_slots, capacity,
 round(utilization_rate, 6) AS utilization_rate, zone_id, snapshot_timestamp, utilization_rank"""
_ZONE = """city, zone_id, snapshot_timestamp,
 round(avg_bikes_available, 6) AS avg_bikes_available,
 round(avg_free_slots, 6) AS avg_free_slots,
 round(avg_utilization_rate, 6) AS avg_utilization_rate, station_count, shortage_flag"""
_IMBALANCE = """city, zone_id, snapshot_timestamp,
 round(avg_bikes_available, 6) AS avg_bikes_available, round(avg_capacity, 6) AS avg_capacity,
 round(zone_availability_ratio, 6) AS zone_availability_ratio,
 round(city_availability_ratio, 6) AS city_availability_ratio,
 round(imbalance_score, 6) AS imbalance_score"""
_CRITICAL = """station_key, city, station_id, station_name, snapshot_timestamp, bikes_available,
 free_slots, round(utilization_rate, 6) AS utilization_rate,
 round(rolling_15m_utilization, 6) AS rolling_15m_utilization, is_empty, alert_level"""
_ACTIVITY = "city, usage_date, usage_hour, estimated_activity"
_WIRE = """arrival_id, station_id, station_name, latitude, longitude, bikes_available, free_slots,
 "timestamp", network_id, city, station_key, ingested_at"""
_SUMMARY = """SELECT city, count(*) AS station_count,
 round(avg(utilization_rate), 6) AS avg_utilization_rate,
 round(avg(bikes_available), 6) AS avg_bikes_available,
 count(*) FILTER (WHERE bikes_available = 0) AS empty_stations,
 count(*) FILTER (WHERE bikes_available <= 2) AS low_stock_stations
 FROM latest GROUP BY city"""
_IMBALANCE_ORDER = "ORDER BY round(abs(imbalance_score), 9) DESC, city, zone_id"
_RECENT = """SELECT city, station_name, alert_type, alert_message, bikes_available, free_slots,
 round(utilization_rate, 6) AS utilization_rate, snapshot_timestamp, created_at
 FROM history ORDER BY created_at DESC, station_key, snapshot_timestamp DESC, alert_type
 LIMIT 100"""
_PARIS = (
    "strftime({0} + CASE WHEN {0} >= TIMESTAMP '2024-03-31 01:00:00' "
    "THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END, '%d/%m/%Y %H:%M:%S')"
)
_PERCENT = "printf('%.1f%%', round({0} * 100, 1))"


def _paris(column: str) -> str:
    return _PARIS.format(column)


def _percent(column: str) -> str:
    return _PERCENT.format(column)


def _movement(name: str) -> str:
    change = f"delta_{name}"
    return f"""replace(format('{{:,}}', {name}), ',', ' ') AS {name}_label,
        CASE WHEN {change} = 0 THEN 'Stable' ELSE printf('%+d', {change}) END AS {name}_change,
        CASE WHEN {change} > 0 THEN 'up' WHEN {change} < 0 THEN 'down' ELSE 'neutral' END
          AS {name}_direction"""


_METRICS = """refreshed_at, latest_snapshot, total_stations,
 round(avg_utilization_rate, 6) AS avg_utilization_rate, empty_stations, critical_station_count"""
_DELTAS = f"""{_METRICS}, delta_total_stations,
 round(delta_avg_utilization_rate, 6) AS delta_avg_utilization_rate, delta_empty_stations,
 delta_critical_station_count, snapshot_changed"""

STATEMENTS = {
    # cleaning
    "clean_snapshots": f"SELECT arrival_id, {_FACT} FROM valid",
    "parse_timestamps": "SELECT arrival_id, snapshot_timestamp, ingested_at FROM typed",
    "repair_timestamps": """
        SELECT arrival_id, regexp_replace("timestamp", '([+]00:00)Z$', '\\1') AS repaired FROM raw""",
    "zone_grid": """
        SELECT arrival_id, printf('%.2f', round(latitude, 2)) || '_'
               || printf('%.2f', round(longitude, 2)) AS zone_id FROM raw""",
    "rejected_records": """
        SELECT arrival_id, station_key, reason FROM (
          SELECT *, CASE WHEN snapshot_timestamp IS NULL THEN 'missing snapshot_timestamp'
                      WHEN ingested_at IS NULL THEN 'missing ingested_at'
                      WHEN bikes_available IS NULL THEN 'missing bikes_available'
                      WHEN free_slots IS NULL THEN 'missing free_slots'
                      WHEN bikes_available < 0 THEN 'negative bikes_available'
                      WHEN free_slots < 0 THEN 'negative free_slots' END AS reason
          FROM typed) WHERE reason IS NOT NULL""",
    "reject_reasons": """
        SELECT reason, count(*) AS rejected_rows FROM (
          SELECT CASE WHEN snapshot_timestamp IS NULL THEN 'missing snapshot_timestamp'
                      WHEN ingested_at IS NULL THEN 'missing ingested_at'
                      WHEN bikes_available IS NULL THEN 'missing bikes_available'
                      WHEN free_slots IS NULL THEN 'missing free_slots'
                      WHEN bikes_available < 0 THEN 'negative bikes_available'
                      WHEN free_slots < 0 THEN 'negative free_slots' END AS reason
          FROM typed) WHERE reason IS NOT NULL GROUP BY reason""",
    "dedupe_snapshots": f"SELECT arrival_id, {_FACT} FROM arrived",
    "transform_snapshots": """
        SELECT DISTINCT station_key, network_id, city, station_id, station_name, zone_id,
               snapshot_timestamp, event_date, event_hour FROM valid""",
    "late_rows": """
        SELECT arrival_id, station_key, snapshot_timestamp, ingest_batch,
               newest - INTERVAL 10 MINUTE AS watermark
        FROM (SELECT *, (arrival_id * 7919) % 10 AS ingest_batch FROM valid) v
        JOIN (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                                              AND 1 PRECEDING) AS newest
              FROM (SELECT (arrival_id * 7919) % 10 AS batch, max(snapshot_timestamp) AS newest
                    FROM valid GROUP BY 1)) w ON v.ingest_batch = w.batch
        WHERE snapshot_timestamp <= newest - INTERVAL 10 MINUTE""",
    # sources
    "encode_records": f"SELECT {_WIRE}, station_key AS message_key FROM raw",
    "decode_records": f"SELECT {_WIRE} FROM raw",
    "explode_snapshot": f"SELECT {_WIRE} FROM raw".replace(
        '"timestamp"', """regexp_replace("timestamp", '([+]00:00)Z$', '\\1') AS "timestamp\""""
    ),
    "normalize_payload": f"SELECT {_WIRE} FROM raw".replace(
        '"timestamp"',
        """CASE WHEN arrival_id % 17 = 0 THEN ingested_at
           ELSE regexp_replace("timestamp", '([+]00:00)Z$', '\\1') END AS "timestamp\"""",
    ),
    "archive_roundtrip": f"SELECT {_FACT} FROM facts",
    "fact_upsert": f"""
        SELECT {_FACT}, CAST(arrival_id * 2 > newest AS BIGINT) AS batch_id
        FROM arrived CROSS JOIN half""",
    "alert_upsert": f"""
        SELECT DISTINCT {_ALERT} FROM (
          SELECT * EXCLUDE (created_at) FROM history
          UNION ALL
          SELECT a.* FROM current_alerts a)""",
    "ensure_schema": f"SELECT {_SHOWN} FROM latest".replace(
        "zone_id,", "CAST(NULL AS VARCHAR) AS zone_id,"
    ),
    "refresh_gold": """
        SELECT 'latest_station_status' AS table_name, count(*) AS row_count FROM latest
        UNION ALL SELECT 'top_utilization_stations', count(*) FROM ranked
        UNION ALL SELECT 'low_availability_zones', count(*) FROM zones
        UNION ALL SELECT 'daily_usage_peaks', count(*) FROM peaks
        UNION ALL SELECT 'hourly_activity', count(*) FROM activity
        UNION ALL SELECT 'geographic_imbalance', count(*) FROM imbalance
        UNION ALL SELECT 'critical_stations', count(*) FROM critical
        UNION ALL SELECT 'station_alerts', count(*) FROM current_alerts""",
    # latest rows and what derives from them
    "incremental_latest": f"SELECT {_FACT} FROM latest",
    "incremental_activity": f"SELECT {_ACTIVITY} FROM activity",
    "incremental_critical": f"SELECT {_CRITICAL} FROM critical",
    "incremental_transitions": _TRANSITIONS,
    "incremental_gold": """
        SELECT table_name, key, detail, seen_at, round(a, 6) AS first_value,
               round(b, 6) AS second_value,
               round(c, 6) AS third_value
        FROM (
          SELECT 'latest_station_status' AS table_name, station_key AS key, city AS detail,
                 snapshot_timestamp AS seen_at, CAST(bikes_available AS DOUBLE) AS a,
                 CAST(free_slots AS DOUBLE) AS b, CAST(utilization_rate AS DOUBLE) AS c FROM latest
          UNION ALL
          SELECT 'top_utilization_stations', station_key, zone_id, snapshot_timestamp,
                 utilization_rank, capacity, utilization_rate FROM ranked
          UNION ALL
          SELECT 'low_availability_zones', city, zone_id, snapshot_timestamp, avg_bikes_available,
                 station_count, CAST(shortage_flag AS INTEGER) FROM zones
          UNION ALL
          SELECT 'daily_usage_peaks', city, '', CAST(usage_date AS TIMESTAMP), usage_hour,
                 estimated_activity, peak_rank FROM peaks
          UNION ALL
          SELECT 'hourly_activity', city, '', CAST(usage_date AS TIMESTAMP), usage_hour,
                 estimated_activity, 0 FROM activity
          UNION ALL
          SELECT 'geographic_imbalance', city, zone_id, snapshot_timestamp, avg_capacity,
                 zone_availability_ratio, imbalance_score FROM imbalance
          UNION ALL
          SELECT 'critical_stations', station_key, alert_level, snapshot_timestamp,
                 bikes_available, rolling_15m_utilization, CAST(is_empty AS INTEGER)
          FROM critical)""",
    "stream_transitions": _TRANSITIONS,
    "stream_late_rows": """
        SELECT station_key, city, snapshot_timestamp, bikes_available, free_slots,
               round(utilization_rate, 6) AS utilization_rate, watermark
        FROM (SELECT *, arrival_id % 3 AS landing FROM valid) v
        JOIN (SELECT landing, max(newest) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND 1 PRECEDING) - INTERVAL 10 MINUTE AS watermark
              FROM (SELECT arrival_id % 3 AS landing, max(snapshot_timestamp) AS newest
                    FROM valid GROUP BY 1)) w USING (landing)
        WHERE snapshot_timestamp <= watermark""",
    "stream_facts": """
        SELECT DISTINCT station_key, network_id, city, station_id, station_name, zone_id,
               snapshot_timestamp, event_date, event_hour FROM valid""",
    "stream_latest": "SELECT station_key, city, snapshot_timestamp FROM latest",
    "latest_status": f"SELECT {_FACT} FROM latest",
    "latest_incremental": f"SELECT {_FACT} FROM latest",
    "top_utilization": f"SELECT {_RANKED} FROM ranked WHERE utilization_rank <= 10",
    "top_utilization_full": f"SELECT {_RANKED} FROM ranked",
    "low_availability_zones": f"SELECT {_ZONE} FROM zones",
    "city_baseline": """
        SELECT city, round(city_availability_ratio, 6) AS city_availability_ratio
        FROM baseline""",
    "geographic_imbalance": f"SELECT {_IMBALANCE} FROM imbalance",
    # history
    "usage_deltas": """
        SELECT station_key, city, event_date, event_hour, snapshot_timestamp, bikes_available,
               free_slots, usage_proxy FROM moves""",
    "hourly_activity": f"SELECT {_ACTIVITY} FROM activity",
    "activity_incremental": f"SELECT {_ACTIVITY} FROM activity",
    "daily_usage_peaks": f"SELECT {_ACTIVITY}, peak_rank FROM peaks",
    "rolling_utilization": """
        SELECT station_key, snapshot_timestamp, round(utilization_rate, 6) AS utilization_rate,
               round(rolling_15m_utilization, 6) AS rolling_15m_utilization FROM rolling""",
    "rolling_latest_join": """
        SELECT station_key, snapshot_timestamp, round(utilization_rate, 6) AS utilization_rate,
               round(rolling_15m_utilization, 6) AS rolling_15m_utilization FROM at_latest""",
    "critical_stations": f"SELECT {_CRITICAL} FROM critical",
    "alerts_empty": f"SELECT {_ALERT} FROM current_alerts WHERE alert_type = 'empty'",
    "alerts_critical": f"SELECT {_ALERT} FROM current_alerts WHERE alert_type = 'critical'",
    "alerts_all": f"SELECT {_ALERT} FROM current_alerts",
    "alert_history": f"SELECT {_ALERT} FROM history",
    "alert_transitions": _TRANSITIONS,
    # serving
    "overview_metrics": """
        SELECT (SELECT count(*) FROM latest) AS total_stations,
               (SELECT count(DISTINCT city) FROM latest) AS tracked_cities,
               (SELECT round(avg(utilization_rate), 6) FROM latest) AS avg_utilization_rate,
               (SELECT count(*) FROM latest WHERE bikes_available = 0) AS empty_stations,
               (SELECT count(*) FROM critical) AS critical_station_count,
               (SELECT count(*) FROM history
                WHERE created_at >= TIMESTAMP '2024-01-02 06:10:00' - INTERVAL 24 HOUR)
                 AS alert_count_24h,
               (SELECT count(*) FROM history
                WHERE created_at >= TIMESTAMP '2024-01-02 06:10:00' - INTERVAL 1 HOUR)
                 AS alert_count_1h""",
    "alert_counts": """
        SELECT count(*) FILTER (WHERE created_at >= newest - INTERVAL 24 HOUR)
                 AS alert_count_24h,
               count(*) FILTER (WHERE created_at >= newest - INTERVAL 1 HOUR) AS alert_count_1h
        FROM history CROSS JOIN (SELECT max(ingested_at) AS newest FROM facts)""",
    "freshness": f"""
        SELECT latest_snapshot, latest_ingested,
               strftime(latest_snapshot, '%Y-%m-%dT%H:%M:%S+00:00') AS snapshot_token,
               age AS age_seconds,
               CASE WHEN age <= 120 THEN 'live' ELSE 'warning' END AS level,
               CASE WHEN age <= 120 THEN '' ELSE 'Flux ancien ou limite. ' END
                 || printf('Dernier snapshot il y a %d min %02d s.', age // 60, age % 60)
                 AS message,
               {_paris('latest_snapshot')} AS latest_snapshot_local,
               {_paris('latest_ingested')} AS latest_ingested_local,
               'Cadence attendue: 60 s' AS cadence
        FROM (SELECT *, greatest(date_diff('second', latest_snapshot,
                                           TIMESTAMP '2024-01-02 06:10:00'), 0) AS age
              FROM (SELECT max(snapshot_timestamp) AS latest_snapshot,
                           max(ingested_at) AS latest_ingested FROM latest))""",
    "city_summary": _SUMMARY,
    "city_options": "SELECT DISTINCT city FROM latest",
    "filter_cities": f"SELECT {_SHOWN} FROM latest WHERE city IN ('city_1', 'city_3')",
    "filter_cities_invalid": f"SELECT {_SHOWN} FROM latest",
    "focus_tension": f"""SELECT {_SHOWN} FROM latest
        WHERE latest.utilization_rate >= 0.85 OR bikes_available <= 2""",
    "focus_empty": f"SELECT {_SHOWN} FROM latest WHERE bikes_available <= 0",
    "serve_latest": f"SELECT {_SHOWN} FROM latest",
    "serve_top_stations": f"""SELECT {_TOP} FROM ranked
        ORDER BY utilization_rank, station_name, station_key LIMIT 10""",
    "serve_zones": f"SELECT {_ZONE} FROM zones",
    "serve_peaks": f"SELECT {_ACTIVITY}, peak_rank FROM peaks",
    "serve_critical": """
        SELECT city, station_name, bikes_available, free_slots,
               round(utilization_rate, 6) AS utilization_rate,
               round(rolling_15m_utilization, 6) AS rolling_15m_utilization, is_empty,
               snapshot_timestamp, alert_level FROM critical""",
    "serve_imbalance": f"SELECT {_IMBALANCE} FROM imbalance",
    "shortage_zones": """
        SELECT city, zone_id, round(avg_bikes_available, 6) AS avg_bikes_available,
               round(avg_utilization_rate, 6) AS avg_utilization_rate
        FROM zones WHERE shortage_flag""",
    "peak_hours": f"SELECT {_ACTIVITY} FROM peaks WHERE peak_rank = 1",
    "top_imbalance": f"""
        SELECT city, zone_id, round(imbalance_score, 6) AS imbalance_score,
               round(zone_availability_ratio, 6) AS zone_availability_ratio,
               round(city_availability_ratio, 6) AS city_availability_ratio
        FROM (SELECT * FROM imbalance {_IMBALANCE_ORDER} LIMIT 20)""",
    "recent_alerts": _RECENT,
    "watchlist": """
        SELECT 'critical' AS list, city, station_name AS item,
               round(rolling_15m_utilization, 6) AS reading
        FROM (SELECT * FROM critical
              ORDER BY snapshot_timestamp DESC, city, station_name, station_key LIMIT 5)
        UNION ALL
        SELECT 'shortage', city, zone_id, round(avg_utilization_rate, 6)
        FROM (SELECT * FROM zones WHERE shortage_flag
              ORDER BY avg_bikes_available, city, zone_id LIMIT 5)
        UNION ALL
        SELECT 'top', city, station_name, round(utilization_rate, 6)
        FROM (SELECT * FROM ranked
              ORDER BY utilization_rank, station_name, station_key LIMIT 5)""",
    # frames
    "map_points": """
        SELECT station_key, city, station_name, latitude AS lat, longitude AS lon FROM latest
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
    "map_centroid": """
        SELECT round(avg(latitude), 6) AS lat, round(avg(longitude), 6) AS lon FROM latest""",
    "station_state": f"""
        SELECT station_key, state AS station_state,
               CASE state WHEN 'vide' THEN '200,85,61,205'
                          WHEN 'sous tension' THEN '183,121,31,205'
                          ELSE '15,118,110,185' END AS fill_color,
               greatest(coalesce(capacity, 4), 4) * 20 AS radius,
               {_percent('utilization_rate')} AS utilization_label,
               {_paris('snapshot_timestamp')} AS snapshot_label
        FROM (SELECT *, CASE WHEN bikes_available <= 0 THEN 'vide'
                             WHEN utilization_rate >= 0.85 OR bikes_available <= 2
                             THEN 'sous tension' ELSE 'normal' END AS state FROM latest)""",
    "activity_series": f"""
        SELECT {_ACTIVITY}, peak_rank,
               CAST(usage_date AS TIMESTAMP) + to_hours(usage_hour) AS period_start
        FROM peaks""",
    "imbalance_bars": f"""
        SELECT {_IMBALANCE},
               CASE WHEN b.imbalance_score < 0 THEN 'Sous-dotee' ELSE 'Sur-dotee' END
                 AS direction,
               city || ' · ' || zone_id AS zone_label
        FROM (SELECT * FROM imbalance {_IMBALANCE_ORDER} LIMIT 12) b""",
    "localized_alerts": f"""
        SELECT city AS "Ville", station_name AS "Station",
               CASE alert_type WHEN 'critical' THEN 'critique' ELSE 'station vide' END
                 AS "Type d'alerte",
               alert_message AS "Message d'alerte", bikes_available AS "Velos disponibles",
               free_slots AS "Bornes libres", {_percent('utilization_rate')}
                 AS "Taux d'utilisation",
               {_paris('snapshot_timestamp')} AS "Horodatage", {_paris('created_at')} AS "Cree le"
        FROM history""",
    "localized_critical": f"""
        SELECT city AS "Ville", station_name AS "Station",
               bikes_available AS "Velos disponibles", free_slots AS "Bornes libres",
               {_percent('utilization_rate')} AS "Taux d'utilisation",
               {_percent('rolling_15m_utilization')} AS "Utilisation glissante 15 min",
               CASE WHEN is_empty THEN 'oui' ELSE 'non' END AS "Station vide",
               {_paris('snapshot_timestamp')} AS "Horodatage",
               CASE alert_level WHEN 'critical' THEN 'critique' ELSE 'vide et critique' END
                 AS "Niveau d'alerte"
        FROM critical""",
    "metric_deltas": f"SELECT {_DELTAS} FROM deltas",
    "metric_delta_labels": f"""
        SELECT refreshed_at, {_movement('total_stations')}, {_movement('empty_stations')},
               {_movement('critical_station_count')},
               {_percent('avg_utilization_rate')} AS avg_utilization_rate_label,
               CASE WHEN abs(delta_avg_utilization_rate) < 0.0005 THEN 'Stable'
                    ELSE printf('%+.1f pts', round(delta_avg_utilization_rate * 100, 1)) END
                 AS avg_utilization_rate_change,
               CASE WHEN delta_avg_utilization_rate > 0.0005 THEN 'up'
                    WHEN delta_avg_utilization_rate < -0.0005 THEN 'down'
                    ELSE 'neutral' END AS avg_utilization_rate_direction
        FROM deltas""",
    # networks and labels
    "match_networks": """
        SELECT requested_city, city, id AS network_id, name AS network_name, href, candidates,
               candidates > 1 AS ambiguous
        FROM (SELECT *, row_number() OVER (PARTITION BY requested_city
                          ORDER BY score, length(trim(city)), lower(name), position) AS nth,
                     count(*) OVER (PARTITION BY requested_city) AS candidates FROM hits)
        WHERE nth = 1""",
    "catalog_targets": """
        SELECT requested_city, city, id AS network_id, name AS network_name, href
        FROM (SELECT *, row_number() OVER (PARTITION BY requested_city
                          ORDER BY score, length(trim(city)), lower(name), position) AS nth
              FROM hits)
        WHERE nth = 1""",
    "unmatched_cities": """
        SELECT requested_city FROM wishes
        WHERE requested_city NOT IN (SELECT requested_city FROM hits)""",
    "normalize_labels": r"""
        SELECT doc_id, trim(regexp_replace(regexp_replace(lower(strip_accents(text)),
                 '[^\x00-\x7F]', '', 'g'), '[\s\x0b\x1c-\x1f]+', ' ', 'g')) AS label
        FROM documents""",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(sql) for name, sql in STATEMENTS.items()}
