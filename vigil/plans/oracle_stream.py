"""DuckDB oracle for the streaming queries: all windows, those open at the end included."""

ORACLE = {
    "stream_window_alerts": """
WITH t AS (SELECT quantile_cont(value, 0.99) AS t FROM events),
w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS ws, value FROM events)
SELECT epoch_us(ws) AS window_start_us, epoch_us(ws + INTERVAL 1 DAY) AS window_end_us, count(*) AS n_events,
       CAST(sum(CASE WHEN value > (SELECT t FROM t) THEN 1 ELSE 0 END) AS BIGINT) AS n_alerts,
       round(sum(CASE WHEN value > (SELECT t FROM t) THEN value ELSE 0.0 END), 6) AS alert_amount
FROM w GROUP BY ws""",
    "stream_velocity": """
WITH b AS (SELECT user_id, value, ts, time_bucket(INTERVAL 10 MINUTE, ts) AS b0 FROM events),
w AS (SELECT user_id, value, b0 - k * INTERVAL 10 MINUTE AS ws, ts
      FROM b, range(6) r(k))
SELECT user_id, epoch_us(ws) AS window_start_us, count(*) AS n_events, round(sum(value), 6) AS total_value
FROM w WHERE ts < ws + INTERVAL 1 HOUR
GROUP BY user_id, ws""",
}
