"""The registered queries in SQL for another engine, written independently of the Spark code."""

from __future__ import annotations

from testkit.faults import PERIOD

# The adapter mapping of the events table, as SQL.
EV = r"""
base AS (
    SELECT event_id AS n, ts AS event_ts, ts + (event_id % 21) * INTERVAL 1 SECOND AS producer_ts,
           CAST(user_id AS VARCHAR) AS user_id, value,
           CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k,
           CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                WHEN 'purchase' THEN 'order_created' WHEN 'signup' THEN 'payment_processed'
                WHEN 'error' THEN 'inventory_updated' END AS event_type
    FROM events
),
ev AS (
    SELECT CAST(n AS VARCHAR) AS event_id, n, k, event_type, event_ts, producer_ts,
           CASE WHEN date_part('microsecond', event_ts) % 1000000 = 0
                THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S+00:00')
                ELSE strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS event_time,
           CASE WHEN date_part('microsecond', producer_ts) % 1000000 = 0
                THEN strftime(producer_ts, '%Y-%m-%dT%H:%M:%S+00:00')
                ELSE strftime(producer_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS producer_time,
           user_id, 'sess_' || user_id AS session_id, 'testdata' AS source,
           CASE WHEN event_type = 'page_view' THEN '/product' END AS page,
           CASE WHEN event_type IN ('page_view', 'add_to_cart', 'inventory_updated')
                THEN 'item-' || CAST(n % 13 AS VARCHAR) END AS product_id,
           CASE WHEN event_type = 'page_view' THEN 'shelf-' || CAST(n % 3 AS VARCHAR) END AS category,
           CASE WHEN event_type = 'page_view' THEN 'direct' END AS referrer,
           CASE WHEN event_type = 'add_to_cart' THEN 1 + k % 4 END AS quantity,
           CASE WHEN event_type = 'add_to_cart' THEN value END AS unit_price,
           CASE WHEN event_type IN ('add_to_cart', 'order_created', 'payment_processed') THEN 'BRL' END AS currency,
           CASE event_type WHEN 'order_created' THEN 'ord_' || CAST(n AS VARCHAR)
                WHEN 'payment_processed' THEN 'ord_' || CAST(n - 1 AS VARCHAR) END AS order_id,
           CASE WHEN event_type = 'order_created' THEN 1 + k % 5 END AS items_count,
           CASE WHEN event_type = 'order_created' THEN value END AS total_amount,
           CASE WHEN event_type = 'order_created' THEN 'web' END AS channel,
           CASE WHEN event_type = 'payment_processed' THEN 'pay_' || CAST(n AS VARCHAR) END AS payment_id,
           CASE WHEN event_type = 'payment_processed' THEN
                CASE n % 5 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'pix' WHEN 2 THEN 'debit_card'
                     WHEN 3 THEN 'wallet' ELSE 'boleto' END END AS payment_method,
           CASE WHEN event_type = 'payment_processed' THEN
                CASE WHEN k < 82 THEN 'approved' WHEN k < 94 THEN 'declined' ELSE 'pending' END END AS payment_status,
           CASE WHEN event_type = 'payment_processed' THEN value END AS amount,
           CASE WHEN event_type = 'inventory_updated' THEN 'wh_0' || CAST(1 + n % 3 AS VARCHAR) END AS warehouse_id,
           CASE WHEN event_type = 'inventory_updated' THEN k - 50 END AS delta_qty,
           CASE WHEN event_type = 'inventory_updated' THEN k END AS stock_after,
           CASE WHEN event_type = 'inventory_updated' THEN 'adjustment' END AS reason
    FROM base
)"""

PAYLOAD = (
    "page, product_id, category, referrer, quantity, unit_price, currency, order_id, items_count, total_amount, "
    "channel, payment_id, payment_method, payment_status, amount, warehouse_id, delta_qty, stock_after, reason"
)
ENVELOPE = "event_id, event_type, event_time, producer_time, user_id, session_id, source"


def metric_ctes(windows: str, active: str = "") -> str:
    """CTE ``metrics`` of all six metrics over a CTE ``w`` of events with their windows."""
    scope = "'scope' AS dimension_key, 'all' AS dimension_value"
    return f"""{EV},
w AS ({windows}),
metrics AS (
    SELECT window_start, window_end, 'events_per_minute' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value,
           'event_type' AS dimension_key, event_type AS dimension_value
    FROM w GROUP BY window_start, window_end, event_type
    UNION ALL
    SELECT window_start, window_end, 'revenue_per_minute', round(sum(coalesce(total_amount, 0)), 6), {scope}
    FROM w WHERE event_type = 'order_created' GROUP BY window_start, window_end
    UNION ALL
    SELECT window_start, window_end, 'orders_per_minute', CAST(count(*) AS DOUBLE), {scope}
    FROM w WHERE event_type = 'order_created' GROUP BY window_start, window_end
    UNION ALL
    SELECT window_start, window_end, 'payment_success_rate',
           round(CAST(sum(CASE WHEN payment_status = 'approved' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6), {scope}
    FROM w WHERE event_type = 'payment_processed' GROUP BY window_start, window_end
    UNION ALL
    SELECT window_start, window_end, 'active_users_per_minute', CAST(count(DISTINCT user_id) AS DOUBLE), {scope}
    FROM w GROUP BY window_start, window_end
    UNION ALL
    SELECT window_start, window_end, 'low_stock_signals_per_minute',
           CAST(sum(CASE WHEN stock_after > 0 AND stock_after <= 10 THEN 1 ELSE 0 END) AS DOUBLE), {scope}
    FROM w WHERE event_type = 'inventory_updated' GROUP BY window_start, window_end
)"""


MINUTES = """SELECT *, date_trunc('minute', event_ts) AS window_start,
    date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end FROM ev"""
SLIDES = """SELECT ev.*, date_trunc('minute', event_ts) - i * INTERVAL 1 MINUTE AS window_start,
    date_trunc('minute', event_ts) - i * INTERVAL 1 MINUTE + INTERVAL 5 MINUTE AS window_end
    FROM ev CROSS JOIN range(5) AS r(i)"""
METRIC = "window_start, window_end, metric_name, metric_value, dimension_key, dimension_value"
BY_MINUTE = metric_ctes(MINUTES)
BY_SLIDE = metric_ctes(SLIDES)
IN_RANGE = "window_start >= TIMESTAMP '2024-01-05 00:00:00' AND window_start <= TIMESTAMP '2024-01-20 12:00:00'"


def _metric(name: str, ctes: str = BY_MINUTE) -> str:
    return f"WITH {ctes} SELECT {METRIC} FROM metrics WHERE metric_name = '{name}'"


def _series(name: str) -> str:
    return (
        f"WITH {BY_MINUTE} SELECT window_start AS time, metric_value AS value FROM metrics "
        f"WHERE metric_name = '{name}' AND {IN_RANGE}"
    )


# The planted faults, each with the one reason it gives (or none, for types without the field).
FAULTY = f"""{EV},
faulty AS (
    SELECT *, CASE n % {PERIOD}
        WHEN 0 THEN 'malformed_json'
        WHEN 1 THEN 'missing:user_id'
        WHEN 2 THEN 'enum:event_type'
        WHEN 3 THEN 'unknown:extra'
        WHEN 4 THEN CASE WHEN event_type <> 'inventory_updated' THEN 'forbidden:warehouse_id' END
        WHEN 5 THEN CASE event_type WHEN 'add_to_cart' THEN 'range:unit_price'
                         WHEN 'order_created' THEN 'range:total_amount'
                         WHEN 'payment_processed' THEN 'range:amount' END
        WHEN 6 THEN 'length:session_id'
        WHEN 7 THEN 'timestamp:event_time'
        WHEN 8 THEN 'type:source'
        WHEN 9 THEN 'unknown:note'
        WHEN 10 THEN 'empty_value'
        WHEN 11 THEN 'not_an_object'
        WHEN 12 THEN CASE WHEN event_type = 'page_view' THEN 'type:referrer' END
        WHEN 13 THEN 'type:payload'
        WHEN 14 THEN CASE event_type WHEN 'add_to_cart' THEN 'range:quantity'
                          WHEN 'order_created' THEN 'range:items_count'
                          WHEN 'inventory_updated' THEN 'range:stock_after' END
        WHEN 15 THEN 'malformed_json'
        WHEN 16 THEN 'malformed_json'
        WHEN 18 THEN CASE event_type WHEN 'add_to_cart' THEN 'range:unit_price'
                          WHEN 'order_created' THEN 'range:total_amount'
                          WHEN 'payment_processed' THEN 'range:amount' END
        WHEN 19 THEN CASE WHEN product_id IS NOT NULL THEN 'missing:product_id' END
        WHEN 20 THEN CASE WHEN event_type = 'inventory_updated' THEN 'range:stock_after' END
        WHEN 21 THEN 'length:session_id,unknown:extra'
        END AS reason_code
    FROM ev
)"""

# Rejects lie under the day of the broker; the types of unreadable and renamed ones are unknown.
ARCHIVE = f"""WITH {FAULTY}
SELECT CASE WHEN reason_code IS NULL THEN 'valid' ELSE 'rejected' END AS verdict,
       CASE WHEN n % {PERIOD} IN (0, 2, 10, 11) THEN 'unknown' ELSE event_type END AS event_type_key,
       strftime(CASE WHEN reason_code IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' + n * INTERVAL 60 SECOND
                     ELSE event_ts END, '%Y-%m-%d') AS event_date,
       count(*) AS n_records, count(*) AS n_raw
FROM faulty GROUP BY ALL"""

def _payments(order_of_order: str, order_of_payment: str) -> str:
    """Payments with their order; of several order events with one id the earliest counts."""
    return f"""{EV},
order_events AS (SELECT *, {order_of_order} AS named FROM ev WHERE event_type = 'order_created'),
orders_seen AS (
    SELECT named AS order_id, event_ts AS order_ts, total_amount AS order_amount, currency AS order_currency,
           user_id AS order_user_id
    FROM order_events QUALIFY row_number() OVER (PARTITION BY named ORDER BY event_ts, event_id) = 1
),
payments AS (
    SELECT event_id, event_ts, payment_id, {order_of_payment} AS order_id, payment_status, amount, currency, user_id
    FROM ev WHERE event_type = 'payment_processed'
),
compared AS (
    SELECT p.*, o.order_ts, o.order_amount, o.order_currency, o.order_user_id,
           CASE WHEN o.order_id IS NOT NULL THEN concat_ws(',',
               CASE WHEN p.amount <> o.order_amount THEN 'amount' END,
               CASE WHEN p.currency <> o.order_currency THEN 'currency' END,
               CASE WHEN p.user_id <> o.order_user_id THEN 'user_id' END) END AS differences
    FROM payments p LEFT JOIN orders_seen o ON p.order_id = o.order_id
),
judged AS (
    SELECT *, CASE WHEN order_ts IS NULL THEN 'orphan' WHEN differences = '' THEN 'match' ELSE 'mismatch' END AS status
    FROM compared
)"""


PAYMENTS = _payments("order_id", "order_id")
HOT_PAYMENTS = _payments(
    "CASE WHEN n % 97 = 0 THEN 'ord_hot' ELSE order_id END",
    "CASE WHEN n % 5 = 0 THEN 'ord_hot' WHEN n % 11 <> 0 THEN order_id END",
)

FLAGS = """CASE WHEN payment_status = 'approved' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS payment_approved_flag,
    CASE WHEN event_type = 'payment_processed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS payment_attempt_flag,
    CASE WHEN stock_after BETWEEN 1 AND 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS low_stock_flag,
    CASE WHEN event_type = 'order_created' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS order_event_flag,
    CASE WHEN event_type = 'page_view' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS page_view_flag"""

DAY = "date_trunc('day', event_ts)::TIMESTAMP AS window_start, date_trunc('day', event_ts) + INTERVAL 1 DAY AS window_end"

# A replay in six files of five days, with a minute of disorder and every fiftieth event two files late; each file is a micro-batch.
REPLAY = f"""{EV}, dealt AS (
    SELECT *, least(CAST(floor((epoch_ms(event_ts) // 1000 + n % 60 - epoch_ms(TIMESTAMP '2024-01-01') // 1000) / 432000) AS INTEGER)
                    + CASE WHEN n % 50 = 7 THEN 2 ELSE 0 END, 5) AS batch_id,
           date_trunc('minute', event_ts) AS window_start, date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end
    FROM ev),
marks AS (
    SELECT batch_id, date_trunc('millisecond', max(max(event_ts)) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                     - INTERVAL 2 MINUTE AS watermark
    FROM dealt GROUP BY batch_id),
judged AS (
    SELECT *, CASE WHEN window_end <= watermark THEN 'late' ELSE 'on_time' END AS verdict FROM dealt JOIN marks USING (batch_id))"""
CLOSED = """(SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 2 MINUTE FROM ev)"""

ORACLE = {
    "parse_events": f"""WITH {EV} SELECT user_id AS kafka_key, 'events.raw' AS kafka_topic, 0 AS kafka_partition,
        n AS kafka_offset, producer_ts AS kafka_timestamp, {ENVELOPE}, {PAYLOAD} FROM ev""",
    "normalize_events": f"""WITH {EV} SELECT event_id, event_type, event_ts, producer_ts,
        coalesce(quantity, 0) AS quantity, coalesce(unit_price, 0) AS unit_price,
        coalesce(items_count, 0) AS items_count, coalesce(total_amount, 0) AS total_amount,
        coalesce(amount, 0) AS amount, coalesce(delta_qty, 0) AS delta_qty, coalesce(stock_after, 0) AS stock_after,
        {FLAGS}, user_id AS active_user_flag FROM ev""",
    "future_event_filter": f"WITH {EV} SELECT event_id, event_ts FROM ev WHERE n % 7 <> 0",
    "events_per_minute": _metric("events_per_minute"),
    "revenue_per_minute": _metric("revenue_per_minute"),
    "orders_per_minute": _metric("orders_per_minute"),
    "payment_success_rate": _metric("payment_success_rate"),
    "active_users_exact": _metric("active_users_per_minute"),
    "active_users_per_minute": _metric("active_users_per_minute"),
    "active_users_accuracy": f"""WITH {EV} SELECT date_trunc('day', event_ts)::TIMESTAMP AS window_start,
        CAST(count(DISTINCT user_id) AS DOUBLE) AS exact_users, TRUE AS within_bound FROM ev GROUP BY 1""",
    "active_users_shipped": f"""WITH {EV}, w AS ({MINUTES}) SELECT window_start, window_end,
        CAST(count(DISTINCT user_id) AS DOUBLE) AS exact_users, TRUE AS within_errors FROM w GROUP BY ALL""",
    "user_rollups": f"""WITH {EV}, grains AS (
            SELECT 'sliding' AS grain, window_start, window_end, user_id FROM ({SLIDES})
            UNION ALL SELECT 'hour', date_trunc('hour', event_ts), date_trunc('hour', event_ts) + INTERVAL 1 HOUR, user_id FROM ev
            UNION ALL SELECT 'day', date_trunc('day', event_ts)::TIMESTAMP, date_trunc('day', event_ts) + INTERVAL 1 DAY, user_id FROM ev)
        SELECT grain, window_start, window_end, count(*) AS n_events, count(DISTINCT user_id) AS exact_users,
               TRUE AS as_from_events, TRUE AS within_errors FROM grains GROUP BY ALL""",
    "producer_lag_rollup": f"""WITH {EV} SELECT date_trunc('hour', event_ts) AS window_start,
        date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end, count(*) AS n_events,
        TRUE AS p50_in_rank, TRUE AS p95_in_rank, TRUE AS p99_in_rank FROM ev GROUP BY ALL""",
    "stream_user_sketches": f"""WITH {EV}, w AS ({MINUTES})
        SELECT date_trunc('hour', event_ts) AS window_start, date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
               count(*) AS n_events, count(DISTINCT user_id) AS exact_users, TRUE AS as_from_events, TRUE AS within_errors
        FROM w WHERE window_end <= (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 2 MINUTE FROM ev) GROUP BY ALL""",
    "low_stock_signals_per_minute": _metric("low_stock_signals_per_minute"),
    "all_metrics": f"WITH {BY_MINUTE} SELECT {METRIC} FROM metrics",
    "sliding_revenue_5m_1m": _metric("revenue_per_minute", BY_SLIDE),
    "sliding_metrics_5m_1m": f"WITH {BY_SLIDE} SELECT {METRIC} FROM metrics",
    "metric_table": f"WITH {BY_MINUTE} SELECT {METRIC} FROM metrics WHERE {IN_RANGE}",
    "metric_table_other_zone": f"WITH {BY_MINUTE} SELECT {METRIC} FROM metrics WHERE {IN_RANGE}",
    "metric_table_compacted": f"WITH {BY_MINUTE} SELECT {METRIC} FROM metrics WHERE {IN_RANGE}",
    "metrics_of_file_records": f"WITH {BY_MINUTE} SELECT {METRIC} FROM metrics",
    # Truncated, empty and array texts have no time, nor has a bad one; one fault renames the type.
    "metrics_of_faulty_records": f"""WITH {EV} SELECT date_trunc('minute', event_ts) AS window_start,
        date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS window_end, 'events_per_minute' AS metric_name,
        CAST(count(*) AS DOUBLE) AS metric_value, 'event_type' AS dimension_key,
        CASE WHEN n % {PERIOD} = 2 THEN 'refund' ELSE event_type END AS dimension_value
        FROM ev WHERE n % {PERIOD} NOT IN (0, 7, 10, 11) GROUP BY ALL""",
    "metric_series": _series("revenue_per_minute"),
    "orders_series": _series("orders_per_minute"),
    "success_series": _series("payment_success_rate"),
    "throughput_series": f"""WITH {BY_MINUTE} SELECT window_start AS time, dimension_value AS metric,
        metric_value AS value FROM metrics
        WHERE metric_name = 'events_per_minute' AND dimension_key = 'event_type' AND {IN_RANGE}""",
    "throughput_table": f"""WITH {BY_MINUTE} SELECT window_start AS time,
        sum(metric_value) FILTER (WHERE dimension_value = 'page_view') AS page_view,
        sum(metric_value) FILTER (WHERE dimension_value = 'add_to_cart') AS add_to_cart,
        sum(metric_value) FILTER (WHERE dimension_value = 'order_created') AS order_created,
        sum(metric_value) FILTER (WHERE dimension_value = 'payment_processed') AS payment_processed,
        sum(metric_value) FILTER (WHERE dimension_value = 'inventory_updated') AS inventory_updated
        FROM metrics WHERE metric_name = 'events_per_minute' AND {IN_RANGE} GROUP BY window_start""",
    "latest_metric": f"""WITH {BY_MINUTE} SELECT metric_name, dimension_key, dimension_value,
        max(window_start) AS time, arg_max(metric_value, window_start) AS value
        FROM metrics WHERE {IN_RANGE} GROUP BY metric_name, dimension_key, dimension_value""",
    "contract_violations": f"""WITH {FAULTY}, each AS (
            SELECT unnest(string_split(reason_code, ',')) AS violation FROM faulty WHERE reason_code IS NOT NULL)
        SELECT violation, count(*) AS n_records FROM each GROUP BY violation""",
    "contract_verdicts": f"""WITH {FAULTY} SELECT n AS kafka_offset, reason_code IS NULL AS is_valid,
        coalesce(reason_code, '') AS reasons FROM faulty""",
    "schema_file_verdicts": f"""WITH {FAULTY} SELECT n AS kafka_offset, reason_code IS NULL AS is_valid,
        coalesce(reason_code, '') AS reasons FROM faulty""",
    "schema_version_changes": f"""WITH {FAULTY} SELECT reason_code IS NULL AS valid_before,
        reason_code IS NULL OR n % {PERIOD} IN (1, 6) AS valid_after,
        CASE n % {PERIOD} WHEN 1 THEN 'missing:user_id' WHEN 6 THEN 'length:session_id'
             WHEN 21 THEN 'length:session_id' ELSE '' END AS gone, '' AS added, count(*) AS n_records FROM faulty GROUP BY ALL""",
    "rejected_events": f"""WITH {FAULTY} SELECT n AS kafka_offset, len(string_split(reason_code, ',')) AS n_reasons FROM faulty
        WHERE reason_code IS NOT NULL""",
    "contract_defaults": f"""WITH {EV} SELECT event_id, event_type,
        CASE WHEN event_type = 'page_view' THEN 'direct' END AS referrer,
        CASE WHEN event_type IN ('add_to_cart', 'payment_processed') THEN 'BRL' END AS currency,
        CASE WHEN event_type = 'order_created' THEN 'web' END AS channel,
        CASE WHEN event_type = 'inventory_updated' THEN 'adjustment' END AS reason FROM ev""",
    "utc_times": f"WITH {EV} SELECT event_id, event_time, producer_time FROM ev",
    "payment_status": f"WITH {HOT_PAYMENTS} SELECT * FROM judged",
    "payment_orphans": f"""WITH {HOT_PAYMENTS} SELECT event_id, event_ts, payment_id, order_id, payment_status, amount,
        currency, user_id FROM judged WHERE status = 'orphan'""",
    "payment_order_match": f"WITH {HOT_PAYMENTS} SELECT * FROM judged WHERE status <> 'orphan'",
    "stock_continuity": f"""WITH {EV}, moves AS (
            SELECT product_id, producer_ts AS moved_at, event_id, warehouse_id, delta_qty, stock_after,
                   lag(stock_after) OVER (PARTITION BY product_id ORDER BY producer_ts, event_id) AS previous_stock
            FROM ev WHERE event_type = 'inventory_updated')
        SELECT *, CAST(previous_stock + delta_qty = stock_after AS INTEGER) AS is_continuous FROM moves""",
    "stock_continuity_keyless": f"""WITH {EV}, moves AS (
            SELECT CASE WHEN n % 3 <> 0 THEN product_id END AS product_id, producer_ts AS moved_at,
                   CASE WHEN n % 3 <> 0 THEN event_id END AS event_id, warehouse_id, delta_qty, stock_after
            FROM ev WHERE event_type = 'inventory_updated'),
        levels AS (SELECT *, CASE WHEN product_id IS NOT NULL THEN
                lag(stock_after) OVER (PARTITION BY product_id ORDER BY moved_at, event_id) END AS previous_stock FROM moves)
        SELECT *, CAST(previous_stock + delta_qty = stock_after AS INTEGER) AS is_continuous FROM levels""",
    "producer_lag": f"""WITH {EV}, d AS (SELECT {DAY}, CAST(n % 21 AS DOUBLE) AS lag FROM ev)
        SELECT window_start, window_end, count(*) AS n_events, round(avg(lag), 6) AS avg_lag, max(lag) AS max_lag
        FROM d GROUP BY window_start, window_end""",
    "producer_lag_quantiles": f"""WITH {EV}, d AS (SELECT {DAY}, CAST(n % 21 AS DOUBLE) AS lag FROM ev)
        SELECT window_start, window_end, count(*) AS n_events, round(avg(lag), 6) AS avg_lag, max(lag) AS max_lag,
               quantile_disc(lag, 0.5) AS p50_lag, quantile_disc(lag, 0.95) AS p95_lag, quantile_disc(lag, 0.99) AS p99_lag
        FROM d GROUP BY window_start, window_end""",
    "event_mix": f"""WITH {EV}, expected(event_type, expected_share) AS (VALUES ('page_view', 0.45::DOUBLE),
            ('add_to_cart', 0.20::DOUBLE), ('order_created', 0.12::DOUBLE), ('payment_processed', 0.13::DOUBLE),
            ('inventory_updated', 0.10::DOUBLE), ('unknown', 0.0::DOUBLE)),
        counted AS (SELECT event_type, count(*) AS n_events FROM ev GROUP BY event_type)
        SELECT x.event_type, coalesce(n_events, 0) AS n_events,
               round(coalesce(n_events, 0)::DOUBLE / (SELECT count(*) FROM ev), 6) AS share, expected_share,
               round(coalesce(n_events, 0)::DOUBLE / (SELECT count(*) FROM ev) - expected_share, 6) + 0 AS deviation
        FROM expected x LEFT JOIN counted c ON x.event_type = c.event_type""",
    "dedup_events": f"""WITH {EV}, twice AS (SELECT * FROM ev UNION ALL SELECT * FROM ev),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts) AS copy FROM twice)
        SELECT event_id, event_type, event_ts, user_id, order_id, coalesce(total_amount, 0) AS total_amount
        FROM numbered WHERE copy = 1""",
    "dedup_keyless": f"""WITH {EV}, copies(copy) AS (VALUES (1), (2))
        SELECT n, CASE WHEN n % 3 <> 0 THEN event_id END AS event_id, event_type, event_ts FROM ev, copies
        WHERE copy = 1 OR n % 3 = 0""",
    "published_records": f"WITH {EV} SELECT user_id AS kafka_key, {ENVELOPE}, {PAYLOAD} FROM ev",
    "topic_routing": f"""WITH {EV} SELECT CASE event_type WHEN 'page_view' THEN 'events.web'
            WHEN 'payment_processed' THEN 'events.payments' WHEN 'inventory_updated' THEN 'events.inventory'
            ELSE 'events.commerce' END AS topic, event_type, count(*) AS n_events FROM ev GROUP BY ALL""",
    "archive": ARCHIVE,
    "stream_archive": ARCHIVE,
    "funnel": f"""WITH {EV}, users AS (
            SELECT {DAY}, user_id, event_type, event_ts FROM ev
            WHERE event_type IN ('page_view', 'add_to_cart', 'order_created')),
        reached AS (
            SELECT window_start, window_end, user_id, bool_or(event_type = 'page_view') AS viewed,
                   bool_or(EXISTS (SELECT 1 FROM users v WHERE v.user_id = u.user_id AND v.window_start = u.window_start
                       AND v.event_type = 'page_view' AND v.event_ts <= u.event_ts) AND event_type = 'add_to_cart') AS carted,
                   bool_or(event_type = 'order_created' AND EXISTS (
                       SELECT 1 FROM users v JOIN users c ON c.user_id = v.user_id AND c.window_start = v.window_start
                       WHERE v.user_id = u.user_id AND v.window_start = u.window_start AND v.event_type = 'page_view'
                         AND c.event_type = 'add_to_cart' AND v.event_ts <= c.event_ts AND c.event_ts <= u.event_ts)) AS ordered
            FROM users u GROUP BY window_start, window_end, user_id),
        steps AS (
            SELECT window_start, window_end, count(*) FILTER (WHERE viewed) AS viewers,
                   count(*) FILTER (WHERE carted) AS carters, count(*) FILTER (WHERE ordered) AS buyers
            FROM reached GROUP BY window_start, window_end)
        SELECT *, round(CASE WHEN viewers > 0 THEN carters::DOUBLE / viewers END, 6) AS view_to_cart,
               round(CASE WHEN carters > 0 THEN buyers::DOUBLE / carters END, 6) AS cart_to_order FROM steps""",
    "anomaly_zscore": f"""WITH {BY_MINUTE}, scored AS (
            SELECT {METRIC}, count(metric_value) OVER recent AS n_history, avg(metric_value) OVER recent AS mean,
                   stddev_samp(metric_value) OVER recent AS deviation
            FROM metrics
            WINDOW recent AS (PARTITION BY metric_name, dimension_key, dimension_value ORDER BY window_start
                RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND INTERVAL 1 SECOND PRECEDING))
        SELECT {METRIC}, n_history, round(mean, 6) + 0 AS mean, round(deviation, 6) + 0 AS deviation,
               round(CASE WHEN deviation > 1e-9 * abs(mean) THEN (metric_value - mean) / deviation END, 6) + 0 AS z_score
        FROM scored""",
    "alerts": f"""WITH {BY_MINUTE}, rules(metric_name, low, high, severity) AS (VALUES
            ('payment_success_rate', 0.5::DOUBLE, NULL::DOUBLE, 'critical'),
            ('events_per_minute', NULL, 2.0, 'info'), ('revenue_per_minute', NULL, 90.0, 'warning'))
        SELECT window_start, m.metric_name, dimension_value, metric_value, severity,
               CASE WHEN metric_value < low THEN 'below' ELSE 'above' END AS breach
        FROM metrics m JOIN rules r ON m.metric_name = r.metric_name
        WHERE metric_value < low OR metric_value > high""",
    # A stream emits the windows that its last watermark has passed.
    "stream_metrics": f"""WITH {BY_MINUTE} SELECT {METRIC} FROM metrics
        WHERE window_end <= (SELECT date_trunc('millisecond', max(event_ts)) - INTERVAL 2 MINUTE FROM ev)""",
    # Matches within the interval bound come at once, orphans when the watermark has passed their bound;
    # it follows the slower of the two sides.
    "stream_payments": f"""WITH {PAYMENTS}, bounded AS (
            SELECT p.event_id, p.order_id, o.order_ts, p.event_ts,
                   CASE WHEN o.order_ts IS NULL THEN 'orphan'
                        WHEN p.amount = o.order_amount AND p.currency = o.order_currency
                             AND p.user_id = o.order_user_id THEN 'match' ELSE 'mismatch' END AS status
            FROM payments p LEFT JOIN orders_seen o ON p.order_id = o.order_id
             AND o.order_ts BETWEEN p.event_ts - INTERVAL 1 HOUR AND p.event_ts + INTERVAL 1 MINUTE)
        SELECT event_id, order_id, order_ts, status FROM bounded
        WHERE status <> 'orphan' OR event_ts + INTERVAL 1 MINUTE
            < (SELECT date_trunc('millisecond', least(max(event_ts) FILTER (WHERE event_type = 'order_created'),
                   max(event_ts) FILTER (WHERE event_type = 'payment_processed'))) - INTERVAL 2 MINUTE FROM ev)""",
    "stream_late_events": f"WITH {REPLAY} SELECT event_id, event_ts, CAST(batch_id AS BIGINT) AS batch_id, verdict FROM judged",
    "stream_lateness": f"""WITH {REPLAY} SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) FILTER (verdict = 'on_time') AS n_on_time,
        count(*) FILTER (verdict = 'late') AS n_late, watermark FROM judged GROUP BY batch_id, watermark""",
    # The aggregation drops by the watermark of the batch before: what is late there by two files.
    "late_by_window": f"""WITH {REPLAY}, before AS (
            SELECT batch_id, lag(watermark) OVER (ORDER BY batch_id) AS dropped_by FROM marks),
        counts AS (
            SELECT window_start, window_end, event_type, count(*) AS n_events,
                   count(*) FILTER (dropped_by IS NULL OR window_end > dropped_by) AS n_counted
            FROM dealt JOIN before USING (batch_id) GROUP BY ALL)
        SELECT * FROM counts WHERE n_events <> n_counted AND window_end <= {CLOSED}""",
    "repaired_metrics": f"""WITH {BY_MINUTE} SELECT {METRIC} FROM metrics
        WHERE metric_name <> 'active_users_per_minute' AND window_end <= {CLOSED}""",
    # A slice of ten seconds comes out when the watermark of inventory events has passed its end.
    "stream_stock_continuity": f"""WITH {EV}, moves AS (
            SELECT product_id, producer_ts AS moved_at, event_id, warehouse_id, delta_qty, stock_after,
                   lag(stock_after) OVER (PARTITION BY product_id ORDER BY producer_ts, event_id) AS previous_stock
            FROM ev WHERE event_type = 'inventory_updated'),
        mark AS (SELECT epoch_ms(max(event_ts)) - 120000 AS ms FROM ev WHERE event_type = 'inventory_updated')
        SELECT moves.*, CAST(previous_stock + delta_qty = stock_after AS INTEGER) AS is_continuous FROM moves, mark
        WHERE (epoch_ms(moved_at) // 10000 + 1) * 10000 <= ms""",
    "stream_dedup_ledger": f"WITH {EV} SELECT event_id, event_type, event_ts FROM ev",
    "stream_dedup": f"WITH {EV} SELECT event_id, event_type, event_ts FROM ev",
}

# Days that the watermark of the funnel's events has closed.
ORACLE["stream_funnel"] = f"""SELECT * FROM ({ORACLE["funnel"]}) WHERE window_end <= (
    SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 MINUTE FROM events WHERE event_type IN ('view', 'click', 'purchase'))"""

# The panels of the six hours up to a fixed moment, both ends included.
ORACLE["recent_panels"] = f"""WITH {BY_MINUTE}, ranged AS (
        SELECT * FROM metrics WHERE window_start BETWEEN TIMESTAMP '2024-01-20 06:00:00' AND TIMESTAMP '2024-01-20 12:00:00')
    SELECT CASE metric_name WHEN 'revenue_per_minute' THEN 'Revenue per Minute' WHEN 'orders_per_minute' THEN 'Orders per Minute'
                WHEN 'payment_success_rate' THEN 'Payment Success Rate' ELSE 'Event Throughput by Type' END AS panel,
           window_start AS time, CASE metric_name WHEN 'events_per_minute' THEN dimension_value END AS series, round(metric_value, 6) AS value
    FROM ranged WHERE metric_name IN ('revenue_per_minute', 'orders_per_minute', 'payment_success_rate', 'events_per_minute')
    UNION ALL
    SELECT CASE metric_name WHEN 'active_users_per_minute' THEN 'Active Users (Latest)' ELSE 'Low Stock Signals (Latest)' END,
           max(window_start), NULL, arg_max(metric_value, window_start)
    FROM ranged WHERE metric_name IN ('active_users_per_minute', 'low_stock_signals_per_minute') GROUP BY metric_name"""

# Scores of counted metrics in windows that closed.
ORACLE["stream_anomaly_zscore"] = f"""SELECT * FROM ({ORACLE["anomaly_zscore"]}) WHERE metric_name <> 'active_users_per_minute'
    AND window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 MINUTE FROM events)"""

# Gaps and islands over the breaching windows of each series, rule and direction.
ORACLE["alert_episodes"] = f"""WITH {BY_MINUTE}, rules(metric_name, low, high, severity) AS (VALUES
        ('payment_success_rate', 0.5::DOUBLE, NULL::DOUBLE, 'critical'), ('events_per_minute', NULL, 2.0, 'info'),
        ('revenue_per_minute', NULL, 90.0, 'warning')),
    breaches AS (
        SELECT *, CASE WHEN metric_value < low THEN 'below' ELSE 'above' END AS breach
        FROM metrics JOIN rules USING (metric_name) WHERE metric_value < low OR metric_value > high),
    marked AS (
        SELECT *, CASE WHEN window_start <= lag(window_start) OVER series + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS is_first
        FROM breaches WINDOW series AS (PARTITION BY metric_name, dimension_value, severity, breach ORDER BY window_start)),
    islands AS (
        SELECT *, sum(is_first) OVER (PARTITION BY metric_name, dimension_value, severity, breach ORDER BY window_start) AS island FROM marked)
    SELECT metric_name, dimension_key, dimension_value, severity, breach, min(window_start) AS opened, max(window_end) AS closed,
           count(*) AS n_windows, round(CASE WHEN breach = 'below' THEN min(metric_value) ELSE max(metric_value) END, 6) AS worst_value
    FROM islands GROUP BY metric_name, dimension_key, dimension_value, severity, breach, island"""
# A session ends ten minutes after the start of its last window.
ORACLE["stream_alert_episodes"] = f"""SELECT * FROM ({ORACLE["alert_episodes"]}) WHERE closed - INTERVAL 1 MINUTE + INTERVAL 10 MINUTE
    <= (SELECT date_trunc('minute', max(ts)) - INTERVAL 1 MINUTE FROM events)"""
ORACLE["event_mix_drift"] = f"""WITH {EV}, mixed AS (
        SELECT {DAY}, CASE WHEN day(event_ts) IN (5, 17) AND n % 3 = 0 THEN 'page_view' ELSE event_type END AS event_type FROM ev),
    counts AS (SELECT window_start, window_end, event_type, count(*) AS k FROM mixed GROUP BY ALL),
    tests AS (
        SELECT window_start, window_end, sum(k)::BIGINT AS n_events, 2 * sum(k * ln(k / (total * 0.2))) AS g
        FROM counts JOIN (SELECT window_start, sum(k) AS total FROM counts GROUP BY window_start) USING (window_start) GROUP BY ALL)
    SELECT window_start, window_end, n_events, 0::BIGINT AS n_unknown, round(greatest(g, 0), 6) AS g,
           round(exp(-g / 2) * (1 + g / 2), 6) + 0 AS p_value, exp(-g / 2) * (1 + g / 2) * count(*) OVER () < 0.01 AS drifted FROM tests"""

# What must hold of the processing times, whatever they are.
ORACLE["stream_processed_at"] = "SELECT 1::BIGINT AS stamps_per_batch, TRUE AS in_order"
