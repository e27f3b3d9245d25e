"""DuckDB SQL equal in meaning to each registered query (the correctness oracle).

Written independently of the Spark code: plain SQL over the supplied tables.
Money is summed as DECIMAL(18,2); every rounding is done exactly in integers,
half-up, as ``(2*num*10^s + den) // (2*den) / 10^s``.
"""

from __future__ import annotations

from tidemark.sources.testdata import FAULTS


def _half_up(num: str, den: str, scale: int) -> str:
    unit = 10 ** scale
    return (f"(CASE WHEN ({den}) > 0 THEN CAST(sign({num}) * ((2 * abs({num}) * {unit} + ({den})) "
            f"// (2 * ({den}))) AS DOUBLE) / CAST({unit} AS DOUBLE) END)")


FUNNEL_COUNTS = """
  SELECT user_id AS customer_id,
         count(*) FILTER (WHERE event_type = 'view') AS "view",
         count(*) FILTER (WHERE event_type = 'click') AS click,
         count(*) FILTER (WHERE event_type = 'signup') AS signup,
         count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_start,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchase
  FROM events GROUP BY user_id"""

SPEND = f"""
  SELECT customer_id, total_orders, total_spend,
         {_half_up('cents', 'n_amounts', 0)} / 100.0::DOUBLE AS avg_order_value
  FROM (SELECT o_custkey AS customer_id, count(o_orderkey) AS total_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend,
               sum(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS cents,
               count(o_totalprice) AS n_amounts
        FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)"""

PROFILE = f"""
  SELECT c.c_custkey AS customer_id, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
         k."view", k.click, k.signup, k.checkout_start, k.purchase,
         coalesce(s.total_orders, 0) AS total_orders,
         coalesce(s.total_spend, 0.0) AS total_spend,
         coalesce(s.avg_order_value, 0.0) AS avg_order_value,
         coalesce({_half_up('k.purchase', 'k.click', 4)}, 0.0) AS conversion_rate
  FROM customer c
  LEFT JOIN ({FUNNEL_COUNTS}) k ON c.c_custkey = k.customer_id
  LEFT JOIN ({SPEND}) s ON c.c_custkey = s.customer_id"""

CATEGORY = """
  SELECT p.p_type AS category,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         count(l.l_orderkey) AS orders
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
  GROUP BY p.p_type"""

ORACLE: dict[str, str] = {
    "customer_profile": PROFILE,
    "customer_funnel": FUNNEL_COUNTS,
    "customer_spend": SPEND,
    "category_performance": CATEGORY + "\n  ORDER BY revenue DESC, category",
    "top_categories": CATEGORY + "\n  ORDER BY revenue DESC, category NULLS LAST LIMIT 5",
    "funnel_dropoff": """
  SELECT CAST(s.stage_no AS INTEGER) AS stage_no, s.stage,
         CAST(coalesce(c.n, 0) AS BIGINT) AS event_count
  FROM (VALUES (1, 'view'), (2, 'click'), (3, 'signup'), (4, 'checkout_start'), (5, 'purchase'))
       AS s(stage_no, stage)
  LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) c
         ON c.event_type = s.stage
  ORDER BY s.stage_no""",
    "event_type_counts": "SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type",
    "avg_conversion": f"""
  SELECT customers_with_views,
         {_half_up('units', 'customers_with_views', 4)} / 10000.0::DOUBLE AS avg_conversion_rate
  FROM (SELECT count(*) AS customers_with_views,
               sum(CAST(round(conversion_rate * 10000) AS BIGINT)) AS units
        FROM ({PROFILE}) WHERE click > 0)""",
}

# ----- staging ---------------------------------------------------------------

# What arrives: the batch export (error events are anonymous) and a second delivery of purchases.
CLICK_RAW = """
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS customer_id,
         CAST(ts AS VARCHAR) AS event_ts, event_type, CAST(value AS VARCHAR) AS value, props
  FROM events, (VALUES (1), (2)) AS copy(n) WHERE n = 1 OR event_type = 'purchase'"""

CLICK_TAGGED = f"""
  SELECT TRY_CAST(event_id AS BIGINT) AS event_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
         TRY_CAST(event_ts AS TIMESTAMP) AS event_ts, event_type, TRY_CAST(value AS DOUBLE) AS value, props,
         CASE WHEN TRY_CAST(event_id AS BIGINT) IS NULL THEN 'invalid_key'
              WHEN customer_id IS NULL OR TRY_CAST(customer_id AS BIGINT) IS NULL THEN 'missing_customer' END AS reason
  FROM ({CLICK_RAW})"""

# Rows without a reason, the first per key.
STAGE_CLICKSTREAM = f"""
  SELECT event_id, customer_id, event_ts, event_type, value, props
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_ts NULLS FIRST, customer_id NULLS FIRST,
                                     event_type NULLS FIRST, value NULLS FIRST, props NULLS FIRST) AS rn
        FROM ({CLICK_TAGGED}) WHERE reason IS NULL)
  WHERE rn = 1"""


def _summary(tagged: str, key: str, reasons: tuple) -> str:
    return f"""
  WITH t AS ({tagged}),
  v AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT {key} FROM t WHERE reason IS NULL)) AS d
        FROM t WHERE reason IS NULL)
  SELECT r.reason AS reject_reason, CAST(count(t.reason) AS BIGINT) AS rejected_rows
  FROM (VALUES {", ".join(f"('{x}')" for x in reasons)}) AS r(reason) LEFT JOIN t ON t.reason = r.reason GROUP BY r.reason
  UNION ALL SELECT 'duplicate', n - d FROM v
  UNION ALL SELECT 'clean', d FROM v"""


STAGE_CLICKSTREAM_REJECTS = _summary(CLICK_TAGGED, "event_id", ("invalid_key", "missing_customer"))

TXN_TYPED = """
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS customer_id,
         l.l_partkey AS product_id, o.o_orderdate AS order_date, l.l_shipdate AS ship_date,
         CAST(trunc(l.l_quantity) AS INTEGER) AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, o.o_orderstatus AS status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

TXN_REASONS = ("invalid_key", "invalid_quantity", "invalid_amount", "missing_customer", "unknown_customer")


def _txn_tagged(typed: str) -> str:
    return f"""
  SELECT t.*, CASE WHEN order_id IS NULL OR line_no IS NULL THEN 'invalid_key'
                   WHEN quantity IS NULL OR quantity <= 0 THEN 'invalid_quantity'
                   WHEN amount IS NULL OR amount <= 0 THEN 'invalid_amount'
                   WHEN customer_id IS NULL THEN 'missing_customer'
                   WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'unknown_customer'
              END AS reason
  FROM ({typed}) t"""


def _txn_first(tagged: str) -> str:
    return f"""
  SELECT order_id, line_no, customer_id, product_id, order_date, ship_date, quantity, amount, status
  FROM (SELECT *, row_number() OVER (
               PARTITION BY order_id, line_no
               ORDER BY ship_date NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,
                        order_date NULLS FIRST, quantity NULLS FIRST, amount NULLS FIRST,
                        status NULLS FIRST) AS rn
        FROM ({tagged}) WHERE reason IS NULL)
  WHERE rn = 1"""


TXN_TAGGED = _txn_tagged(TXN_TYPED)
STAGE_TRANSACTIONS = _txn_first(TXN_TAGGED)
STAGE_TRANSACTIONS_REJECTS = _summary(TXN_TAGGED, "order_id, line_no", TXN_REASONS)

# The same lines as text with faults by rule, then the staging rule over that text.
FAULTY_RAW = f"""
  SELECT {", ".join(f"{FAULTS.get(c, c)} AS {c}" for c in (
      "order_id", "line_no", "customer_id", "product_id", "order_date", "ship_date", "quantity", "amount", "status"))}
  FROM (SELECT l.l_orderkey AS o, l.l_linenumber AS n, CAST(l.l_orderkey AS VARCHAR) AS order_id,
               CAST(l.l_linenumber AS VARCHAR) AS line_no, CAST(o.o_custkey AS VARCHAR) AS customer_id,
               CAST(l.l_partkey AS VARCHAR) AS product_id, CAST(o.o_orderdate AS VARCHAR) AS order_date,
               CAST(l.l_shipdate AS VARCHAR) AS ship_date, CAST(l.l_quantity AS VARCHAR) AS quantity,
               CAST(l.l_extendedprice AS VARCHAR) AS amount, o.o_orderstatus AS status
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey), (VALUES (1), (2)) AS copy(k)
  WHERE k = 1 OR o % 5 = 0"""

FAULTY_TYPED = f"""
  SELECT TRY_CAST(trim(order_id) AS BIGINT) AS order_id, TRY_CAST(trim(line_no) AS INTEGER) AS line_no,
         TRY_CAST(trim(customer_id) AS BIGINT) AS customer_id, TRY_CAST(trim(product_id) AS BIGINT) AS product_id,
         TRY_CAST(trim(order_date) AS TIMESTAMP) AS order_date, TRY_CAST(trim(ship_date) AS TIMESTAMP) AS ship_date,
         TRY_CAST(trunc(TRY_CAST(trim(quantity) AS DOUBLE)) AS INTEGER) AS quantity,
         TRY_CAST(trim(amount) AS DECIMAL(18,2)) AS amount, status
  FROM ({FAULTY_RAW})"""
FAULTY_TAGGED = _txn_tagged(FAULTY_TYPED)

DEDUPE_FIRST = """
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM (SELECT *, row_number() OVER (
               PARTITION BY l_orderkey, l_linenumber
               ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                        l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                        l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS rn
        FROM lineitem)
  WHERE rn = 1"""

ORACLE.update({
    "stage_clickstream": STAGE_CLICKSTREAM,
    "stage_clickstream_rejects": STAGE_CLICKSTREAM_REJECTS,
    "stage_transactions": STAGE_TRANSACTIONS,
    "stage_transactions_rejects": STAGE_TRANSACTIONS_REJECTS,
    "dedupe_first": DEDUPE_FIRST,
    "semi_join_valid": """
  SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
    "semi_join_known_keys": """
  SELECT * FROM orders o WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_nationkey % 2 = 0)""",
    "anti_join_new_keys": """
  SELECT * FROM orders a WHERE NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_linestatus = 'F'
                                                                      AND s.l_orderkey = a.o_orderkey)""",
    "stage_faulty_transactions": _txn_first(FAULTY_TAGGED),
    "stage_faulty_transactions_rejects": _summary(FAULTY_TAGGED, "order_id, line_no", TXN_REASONS),
    "category_performance_orphans": CATEGORY.replace(
        "l.l_partkey = p.p_partkey", "l.l_partkey = p.p_partkey AND l.l_partkey % 7 <> 0"),
})

# ----- data quality ----------------------------------------------------------

DQ_AS_OF = "TIMESTAMP '2001-09-01 00:00:00'"


def _dq_row(name: str, table: str, part: str, total: str, threshold: float, detail_tail: str,
            source: str) -> str:
    return f"""
  SELECT '{name}' AS check_name, '{table}' AS "table",
         CASE WHEN (CASE WHEN {total} > 0 THEN {part} / {total} ELSE 0.0 END) >= {threshold!r}
              THEN 'PASS' ELSE 'FAIL' END AS status,
         coalesce({_half_up(part, total, 4)}, 0.0) AS metric_value,
         CAST({threshold!r} AS DOUBLE) AS threshold,
         format('{{:,}}', {part}) || '/' || format('{{:,}}', {total}) || '{detail_tail}' AS detail,
         {DQ_AS_OF} AS run_ts
  FROM ({source})"""


DQ_COMPLETENESS = _dq_row(
    "completeness", "orders", "part", "total", 0.98,
    " rows complete across [''o_custkey'', ''o_totalprice'', ''o_orderdate'']",
    "SELECT count(*) AS total, count(*) FILTER (WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL"
    " AND NOT isnan(o_totalprice) AND o_orderdate IS NOT NULL) AS part FROM orders")


def _dq_unique(table: str, key: str, label: str | None = None) -> str:
    return _dq_row("uniqueness", table, "part", "total", 0.999,
                   f" unique values for {label or key}",
                   f"SELECT count(*) AS total, count(DISTINCT {key}) AS part FROM {table}")


def _dq_ri(table: str, fk: str) -> str:
    return _dq_row("referential_integrity", table, "part", "total", 0.99,
                   f" rows have a valid {fk} reference",
                   f"SELECT count(*) AS total, count(*) FILTER (WHERE {fk} IN "
                   f"(SELECT c_custkey FROM customer)) AS part FROM {table}")


DQ_FRESHNESS = f"""
  SELECT 'freshness' AS check_name, 'orders' AS "table",
         CASE WHEN total > 0 AND latest IS NOT NULL AND age <= 3650 THEN 'PASS' ELSE 'FAIL' END AS status,
         CASE WHEN total > 0 THEN CAST(age AS DOUBLE) END AS metric_value,
         CAST(3650 AS DOUBLE) AS threshold,
         CASE WHEN total = 0 THEN 'Table is empty'
              WHEN latest IS NULL THEN 'No valid o_orderdate values'
              ELSE 'Latest record is ' || CAST(age AS VARCHAR) || ' days old (max allowed: 3650)' END
           AS detail,
         {DQ_AS_OF} AS run_ts
  FROM (SELECT total, latest,
               CASE WHEN us >= 0 THEN us // 86400000000
                    ELSE -((-us + 86400000000 - 1) // 86400000000) END AS age
        FROM (SELECT count(*) AS total, max(o_orderdate) AS latest,
                     date_diff('microsecond', max(o_orderdate), {DQ_AS_OF}) AS us FROM orders))"""

DQ_SUITE_SQL = "\n  UNION ALL ".join([
    DQ_COMPLETENESS, _dq_unique("orders", "o_orderkey"), _dq_ri("orders", "o_custkey"),
    DQ_FRESHNESS, _dq_unique("customer", "c_custkey"), _dq_unique("events", "event_id"),
    _dq_ri("events", "user_id")])

ORACLE.update({
    "dq_completeness": DQ_COMPLETENESS,
    "dq_uniqueness": _dq_unique("orders", "o_orderkey"),
    "dq_uniqueness_composite": _dq_row(
        "uniqueness", "lineitem", "part", "total", 0.999,
        " unique values for [''l_orderkey'', ''l_linenumber'']",
        "SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber"
        " FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)) AS part"
        " FROM lineitem"),
    "dq_referential_integrity": _dq_ri("orders", "o_custkey"),
    "dq_freshness": DQ_FRESHNESS,
    "dq_suite": DQ_SUITE_SQL,
    "dq_suite_summary": f"""
  SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'FAIL') AS failed
  FROM ({DQ_SUITE_SQL})""",
})

_FAULTY_ORDERS = """(SELECT CASE WHEN o_orderkey % 9 = 0 THEN 9 ELSE o_orderkey END AS o_orderkey,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 10 = 1 THEN -o_custkey ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderkey % 15 = 2 THEN 'nan'::DOUBLE ELSE o_totalprice END AS o_totalprice, o_orderdate FROM orders)"""
ORACLE["dq_suite_faulty"] = "\n  UNION ALL ".join(
    sql.replace("FROM orders", f"FROM {_FAULTY_ORDERS}") for sql in (
        DQ_COMPLETENESS, _dq_unique("orders", "o_orderkey"), _dq_ri("orders", "o_custkey"),
        DQ_FRESHNESS.replace("3650", "30"))) + "\n  UNION ALL " + _dq_unique("customer", "c_custkey")

ORACLE["dq_freshness_text"] = DQ_FRESHNESS.replace(
    "FROM orders", "FROM (SELECT TRY_CAST(CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END"
                   " AS TIMESTAMP) AS o_orderdate FROM orders)")
ORACLE["dq_results_retry"] = DQ_SUITE_SQL

# ----- stream records --------------------------------------------------------

# Records as delivered: error events are not base64, purchases come twice.
EVENTS_DELIVERED = """
  SELECT event_id, user_id AS customer_id, ts AS event_ts, event_type, value, props
  FROM events, (VALUES (1), (2)) AS copy(n)
  WHERE event_type <> 'error' AND (n = 1 OR event_type = 'purchase')"""

# The fault of a record by its event id, in the order the decoder judges.
FAULTY_REASON = """CASE WHEN event_id % 11 = 0 OR event_id % 7 = 1 THEN 'invalid_base64'
              WHEN event_id % 7 = 2 THEN 'invalid_utf8' WHEN event_id % 7 = 3 THEN 'empty_payload'
              WHEN event_id % 7 IN (4, 5) THEN 'malformed_json' END"""

ORACLE.update({
    "json_decode": EVENTS_DELIVERED,
    "json_dead_letter": """
  SELECT CAST(event_id AS VARCHAR) AS _sequence_number, 'invalid_base64' AS _dead_letter_reason
  FROM events WHERE event_type = 'error'""",
    "json_decode_faulty": f"""
  SELECT event_id, user_id AS customer_id, ts AS event_ts, event_type, value, props
  FROM events WHERE {FAULTY_REASON} IS NULL""",
    "json_dead_letter_faulty": f"""
  SELECT CAST(event_id AS VARCHAR) AS _sequence_number, {FAULTY_REASON} AS _dead_letter_reason
  FROM events WHERE {FAULTY_REASON} IS NOT NULL""",
    "stream_landing": EVENTS_DELIVERED,
    "stream_landing_progress": f"""
  SELECT 8 AS batches, (SELECT count(*) FROM ({EVENTS_DELIVERED})) AS landed,
         (SELECT count(*) FROM events WHERE event_type = 'error') AS dead""",
    "stream_batch_convergence": STAGE_CLICKSTREAM,
    "stream_dedupe": STAGE_CLICKSTREAM,
})

# ----- sources ---------------------------------------------------------------

ORACLE.update({
    "union_sources": """
  SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS customer_id,
         ts AS event_ts, event_type, value, props, NULL AS _sequence_number
  FROM events WHERE ts < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT event_id, user_id, ts, event_type, NULL, props, CAST(event_id AS VARCHAR)
  FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'error'
  UNION ALL
  SELECT event_id, user_id, ts, event_type, NULL, props, CAST(event_id AS VARCHAR)
  FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type = 'purchase'""",
    "schema_drift_merged": """
  SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS INTEGER) AS k
  FROM events WHERE ts < TIMESTAMP '2024-01-16'
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, NULL,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)
  FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "schema_drift_types": """
  SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN event_id::DOUBLE WHEN 1 THEN (event_id::BIGINT * 1000003 + 9007199254740000)::DOUBLE
              ELSE value END AS reading,
         CASE event_id % 4 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN (event_id::BIGINT * 1000003 + 9007199254740000)::VARCHAR
              WHEN 2 THEN ts::DATE::VARCHAR ELSE event_type END AS note
  FROM events""",
    "schema_drift_losses": """
  SELECT 'reading' AS column, 'bigint' AS from_type, 'double' AS to_type, x::VARCHAR AS value, count(*) AS rows
  FROM (SELECT event_id::BIGINT * 1000003 + 9007199254740000 AS x FROM events WHERE event_id % 4 = 1)
  WHERE x::DOUBLE::HUGEINT <> x GROUP BY x""",
    "incremental_ingest": STAGE_CLICKSTREAM,
    "csv_text_scan": "SELECT * FROM orders",
    "zone_sql": """
  SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment""",
})

# ----- storage lifecycle -----------------------------------------------------

RETENTION = """
  SELECT partition_date, rows, bytes, age_days,
         CASE WHEN age_days >= 1825 THEN 'EXPIRED' WHEN age_days >= 90 THEN 'GLACIER'
              WHEN age_days >= 30 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS storage_class
  FROM (SELECT CAST(o_orderdate AS DATE) AS partition_date, count(*) AS rows,
               CAST(sum(CASE WHEN o_orderkey IS NULL THEN 0 ELSE 8 END
                   + CASE WHEN o_custkey IS NULL THEN 0 ELSE 8 END
                   + coalesce(octet_length(encode(o_orderstatus)), 0)
                   + CASE WHEN o_totalprice IS NULL THEN 0 ELSE 8 END
                   + CASE WHEN o_orderdate IS NULL THEN 0 ELSE 8 END
                   + coalesce(octet_length(encode(o_orderpriority)), 0)) AS BIGINT) AS bytes,
               CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-15') AS INTEGER)
                 AS age_days
        FROM orders GROUP BY CAST(o_orderdate AS DATE))"""

ORACLE.update({
    "retention_tiers": RETENTION,
    "tier_cost": f"""
  SELECT storage_class, count(*) AS units, sum(bytes) / CAST(1073741824 AS DOUBLE) AS gb,
         sum(bytes) / CAST(1073741824 AS DOUBLE) *
           CASE storage_class WHEN 'STANDARD' THEN 0.025 WHEN 'STANDARD_IA' THEN 0.0138
                              WHEN 'GLACIER' THEN 0.0045 ELSE 0.0 END AS monthly_cost,
         sum(bytes) / CAST(1073741824 AS DOUBLE) * 0.025 AS monthly_cost_untiered
  FROM ({RETENTION}) GROUP BY storage_class""",
})

# ----- metrics and alarms ------------------------------------------------------


def _period(ts: str, seconds: int) -> str:
    us = seconds * 1_000_000
    return f"make_timestamp((epoch_us({ts}) // {us}) * {us})"


ORACLE.update({
    "metric_rollup": f"""
  SELECT metric, period_start, period_start + INTERVAL 300 SECOND AS period_end, samples,
         CAST(units AS DOUBLE) / 1000000.0::DOUBLE AS "sum", "max", "min",
         {_half_up('units', 'samples', 0)} / 1000000.0::DOUBLE AS "avg"
  FROM (SELECT event_type AS metric, {_period('ts', 300)} AS period_start, count(value) AS samples,
               sum(CAST(CAST(value AS DECIMAL(38,6)) * 1000000 AS BIGINT)) AS units,
               max(value) AS "max", min(value) AS "min"
        FROM events GROUP BY ALL)""",
    "metric_alarm": f"""
  WITH s AS (SELECT 'errors' AS metric, {_period('ts', 300)} AS period_start,
                    CAST(count(*) AS DOUBLE) AS stat_value
             FROM events WHERE event_type = 'error' GROUP BY ALL),
  g AS (SELECT metric, unnest(generate_series(min(period_start), max(period_start),
                                              INTERVAL 300 SECOND)) AS period_start
        FROM s GROUP BY metric),
  d AS (SELECT g.metric, g.period_start, s.stat_value,
               CASE WHEN s.stat_value IS NULL THEN false ELSE s.stat_value > 0.0 END AS breaching
        FROM g LEFT JOIN s ON g.metric = s.metric AND g.period_start = s.period_start)
  SELECT metric, period_start, stat_value, breaching,
         CASE WHEN breaching THEN 'ALARM' ELSE 'OK' END AS state FROM d""",
    "metric_alarm_consecutive": f"""
  WITH s AS (SELECT event_type AS metric, {_period('ts', 300)} AS period_start,
                    max(value) AS stat_value
             FROM events GROUP BY ALL),
  b AS (SELECT *, stat_value > 200.0 AS breaching FROM s)
  SELECT metric, period_start, stat_value, breaching,
         CASE WHEN breaching AND coalesce(lag(breaching) OVER (PARTITION BY metric ORDER BY period_start), false)
              THEN 'ALARM' ELSE 'OK' END AS state
  FROM b""",
})

ORACLE["stream_lag"] = f"""
  WITH s AS (SELECT 'stream_lag_ms' AS metric, {_period('l_shipdate', 300)} AS period_start,
                    max(CAST(date_diff('millisecond', o_orderdate, l_shipdate) AS DOUBLE)) AS stat_value
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
  b AS (SELECT *, stat_value > 60000.0 AS breaching FROM s)
  SELECT metric, period_start, stat_value, breaching,
         CASE WHEN breaching AND coalesce(lag(breaching) OVER (PARTITION BY metric ORDER BY period_start), false)
              THEN 'ALARM' ELSE 'OK' END AS state
  FROM b"""
# Periods that end at or before the last event less the delay.
ORACLE["stream_alarm"] = f"""
  SELECT * FROM ({ORACLE["metric_alarm_consecutive"]})
  WHERE period_start + INTERVAL 300 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE"""

# A shard holds the events of one remainder, in order, 500 of them in each batch.
ORACLE["stream_landing_bounded"] = """
  WITH r AS (SELECT event_type, (row_number() OVER (PARTITION BY event_id % 16 ORDER BY event_id) - 1) // 500 AS batch_id
             FROM events, (VALUES (1), (2)) AS copy(n) WHERE n = 1 OR event_type = 'purchase')
  SELECT batch_id, count(*) FILTER (WHERE event_type <> 'error') AS landed, count(*) FILTER (WHERE event_type = 'error') AS dead
  FROM r GROUP BY batch_id"""

# The states of all periods of a grid; those of missing ones are put together per gap and state.
def _alarm_intervals(until: str) -> str:
    return f"""
  WITH s AS (SELECT event_type AS metric, {_period("ts", 300)} AS period_start, max(value) AS stat_value FROM events GROUP BY ALL),
  c AS (SELECT * FROM s WHERE {until}),
  g AS (SELECT metric, unnest(generate_series(min(period_start), max(period_start), INTERVAL 300 SECOND)) AS period_start FROM c GROUP BY metric),
  b AS (SELECT g.metric, g.period_start, c.stat_value, c.metric IS NULL AS missing, coalesce(c.stat_value > 200.0, true) AS breaching
        FROM g LEFT JOIN c ON g.metric = c.metric AND g.period_start = c.period_start),
  r AS (SELECT *, CASE WHEN min(breaching::INT) OVER w = 1 AND count(*) OVER w = 3 THEN 'ALARM' ELSE 'OK' END AS state,
               count(*) FILTER (WHERE NOT missing) OVER (PARTITION BY metric ORDER BY period_start) AS gap
        FROM b WINDOW w AS (PARTITION BY metric ORDER BY period_start ROWS 2 PRECEDING))
  SELECT metric, period_start, 1::BIGINT AS periods, stat_value, breaching, state FROM r WHERE NOT missing
  UNION ALL SELECT metric, min(period_start), count(*), NULL, true, state FROM r WHERE missing GROUP BY metric, gap, state"""


ORACLE["metric_alarm_intervals"] = _alarm_intervals("true")
ORACLE["stream_alarm_kept"] = _alarm_intervals("period_start + INTERVAL 300 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE")

# Drops are eighths of the time of arrival. A row is late if it happened a day or more before the latest event of
# the drops before.
ORACLE["stream_late_rows"] = """
  WITH a AS (
    SELECT event_id, epoch_us(ts) AS us, epoch_us(CASE WHEN event_id % 10 = 0 THEN ts + INTERVAL 72 HOUR ELSE ts END) AS arrival FROM events
    UNION ALL SELECT event_id, epoch_us(ts), epoch_us(CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 48 HOUR ELSE ts + INTERVAL 12 HOUR END)
    FROM events WHERE event_type = 'purchase'),
  b AS (SELECT min(arrival) AS first, (max(arrival) - min(arrival) + 1 + 7) // 8 AS step FROM a),
  d AS (SELECT event_id, us, (arrival - first) // step AS drop_no FROM a, b),
  w AS (SELECT drop_no, max(max(us)) OVER (ORDER BY drop_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 86400000000 AS wm
        FROM d GROUP BY drop_no),
  t AS (SELECT event_id, coalesce(us <= wm, false) AS late FROM d JOIN w USING (drop_no))
  SELECT event_id, CAST(least(count(*) FILTER (WHERE NOT late), 1) AS BIGINT) AS kept,
         CAST(greatest(count(*) FILTER (WHERE NOT late) - 1, 0) AS BIGINT) AS repeats, count(*) FILTER (WHERE late) AS late
  FROM t GROUP BY event_id"""

# ----- the whole run -------------------------------------------------------------

ORACLE["medallion_customer_360"] = f"""
  WITH click AS (SELECT user_id AS customer_id, event_type FROM events WHERE event_type <> 'error'),
  counts AS (
    SELECT customer_id,
           count(*) FILTER (WHERE event_type = 'view') AS "view",
           count(*) FILTER (WHERE event_type = 'click') AS click,
           count(*) FILTER (WHERE event_type = 'signup') AS signup,
           count(*) FILTER (WHERE event_type = 'checkout_start') AS checkout_start,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchase
    FROM click GROUP BY customer_id),
  lines AS ({STAGE_TRANSACTIONS}),
  spend AS (
    SELECT customer_id, total_orders, total_spend,
           {_half_up('cents', 'n_amounts', 0)} / 100.0::DOUBLE AS avg_order_value
    FROM (SELECT customer_id, count(order_id) AS total_orders,
                 CAST(sum(amount) AS DOUBLE) AS total_spend,
                 sum(CAST(amount * 100 AS BIGINT)) AS cents, count(amount) AS n_amounts
          FROM lines WHERE status = 'F' GROUP BY customer_id))
  SELECT c.c_custkey AS customer_id, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
         k."view", k.click, k.signup, k.checkout_start, k.purchase,
         coalesce(s.total_orders, 0) AS total_orders,
         coalesce(s.total_spend, 0.0) AS total_spend,
         coalesce(s.avg_order_value, 0.0) AS avg_order_value,
         coalesce({_half_up('k.purchase', 'k.click', 4)}, 0.0) AS conversion_rate
  FROM customer c
  LEFT JOIN counts k ON c.c_custkey = k.customer_id
  LEFT JOIN spend s ON c.c_custkey = s.customer_id"""

ORACLE["medallion_counts"] = f"""
  WITH c AS ({CLICK_TAGGED}), t AS ({TXN_TAGGED})
  SELECT 'raw.customers' AS name, count(*) AS rows FROM customer
  UNION ALL SELECT 'raw.products', count(*) FROM part
  UNION ALL SELECT 'raw.clickstream_events', count(*) FROM c
  UNION ALL SELECT 'raw.transactions', count(*) FROM t
  UNION ALL SELECT 'staged.customers', count(*) FROM customer
  UNION ALL SELECT 'staged.products', count(*) FROM part
  UNION ALL SELECT 'staged.clickstream_events', count(DISTINCT event_id) FROM c WHERE reason IS NULL
  UNION ALL SELECT 'staged.transactions', count(DISTINCT (order_id, line_no)) FROM t WHERE reason IS NULL
  UNION ALL SELECT 'rejected.clickstream_events', count(reason) FROM c
  UNION ALL SELECT 'rejected.transactions', count(reason) FROM t
  UNION ALL SELECT 'duplicate.clickstream_events', count(*) - count(DISTINCT event_id) FROM c WHERE reason IS NULL
  UNION ALL SELECT 'duplicate.transactions', count(*) - count(DISTINCT (order_id, line_no)) FROM t WHERE reason IS NULL"""

ORACLE["medallion_incremental"] = ORACLE["medallion_customer_360"]
ORACLE["medallion_compacted"] = ORACLE["medallion_customer_360"]


def _arrival_steps(fact: str, key: str) -> str:
    """Counts per step from rows (key..., file, late, never, refused): file 1 or 2 is the step they arrive in.

    Rows of late customers wait until step 3, those of customers that never come for ever. A key has one customer.
    """
    def step(i: int) -> str:
        here, known = f"file = {i}", "NOT refused AND NOT late AND NOT never"
        staged = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM r WHERE {known} AND {here}" + \
            (f" EXCEPT SELECT {key} FROM r WHERE {known} AND file = 1" if i == 2 else "") + "))"
        pending = f"(SELECT count(*) FROM r WHERE NOT refused AND (late OR never) AND file <= {i})"
        valid = f"(SELECT count(*) FROM r WHERE {known} AND {here})"
        refused = f"(SELECT count(*) FROM r WHERE refused AND {here})"
        if i == 3:
            staged = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM r WHERE NOT refused AND late))"
            valid = "(SELECT count(*) FROM r WHERE NOT refused AND late)"
        if i == 4:
            staged = valid = "0"
        if i > 2:
            pending, refused = "(SELECT count(*) FROM r WHERE NOT refused AND never)", "0"
        raw = f"(SELECT count(*) FROM r WHERE {here})"
        rows = {"raw": raw, "staged": staged, "rejected": f"{refused} + {pending}", "pending": pending, "duplicate": f"{valid} - {staged}"}
        return " UNION ALL ".join(f"SELECT {i} AS step, '{k}.{fact}' AS name, CAST({v} AS BIGINT) AS rows" for k, v in rows.items())
    return " UNION ALL ".join(step(i) for i in range(1, 5))


# Batch events first, then the records of a stream: error events are anonymous in the one and dead letters
# in the other, purchases are delivered twice.
ORACLE["medallion_full_then_incremental"] = f"""
  SELECT * FROM (WITH r AS (
      SELECT event_id, file, user_id % 3 = 0 AS late, user_id NOT IN (SELECT c_custkey FROM customer) AS never,
             event_type = 'error' AS refused
      FROM events, (VALUES (1, 1), (2, 1), (2, 2)) AS copy(file, n)
      WHERE file = 1 OR (event_type <> 'error' AND (n = 1 OR event_type = 'purchase')))
    {_arrival_steps("clickstream_events", "event_id")})
  UNION ALL SELECT * FROM (WITH r AS (
      SELECT order_id, line_no, file, coalesce(customer_id % 3 = 0 AND reason IS NULL, false) AS late,
             coalesce(reason = 'unknown_customer', false) AS never, coalesce(reason <> 'unknown_customer', false) AS refused
      FROM ({TXN_TAGGED}), (VALUES (1), (2)) AS f(file)
      WHERE (file = 1 AND order_id % 2 = 0) OR (file = 2 AND (order_id % 2 = 1 OR order_id % 10 = 0)))
    {_arrival_steps("transactions", "order_id, line_no")})"""

ORACLE["coerce_numeric"] = """
  SELECT event_id, json_extract_string(props, '$.k') AS k_text,
         CAST(trunc(TRY_CAST(trim(json_extract_string(props, '$.k')) AS DOUBLE)) AS INTEGER) AS k_quantity,
         TRY_CAST(trim(json_extract_string(props, '$.k')) AS DECIMAL(18,2)) AS k_amount,
         CAST(trunc(value) AS INTEGER) AS value_quantity,
         CAST(value AS DECIMAL(18,2)) AS value_amount
  FROM events"""
