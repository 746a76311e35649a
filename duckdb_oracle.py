"""DuckDB oracle SQL for every registered query (correctness gate).

Independent of the Spark code path on purpose:

* the fixture is re-derived directly as typed rows (no JSON), redeliveries
  included, and Silver keeps the first delivery with ``QUALIFY ROW_NUMBER``;
* Gold follows the *window + self-join* shape of the original SQL models,
  while the Spark side uses single aggregates;
* averages are ``double(sum) / count`` on both sides (an exact sum and one
  correctly rounded division), decimal sums are cast to Spark's result type.
"""

from __future__ import annotations

from pathlib import Path

from medallion.operators.quality import SUITE, Check

T0 = "TIMESTAMP '2026-01-01 00:00:00'"
T1 = "TIMESTAMP '2026-01-01 01:00:00'"
CAL_START, CAL_END = "1995-01-01", "2000-12-31"
SEED = Path(__file__).resolve().parent / "medallion" / "seeds" / "dim_products.csv"


def _silver(name: str, base: str, cols: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _ingested_at, _source_file) AS rn
    FROM (
      SELECT {cols}, 'events/events-' || f AS _source_file, {T0} AS _ingested_at FROM {base}
      UNION ALL
      SELECT {cols}, 'events/retry/events-' || f AS _source_file, {T1} AS _ingested_at FROM {base} WHERE k % 10 = 0
    )
  ) WHERE rn = 1
)"""


FIXTURE = f"""
ob AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderstatus,
         o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS BIGINT)) AS created_at,
         CAST(coalesce(lc.n, 0) AS INTEGER) AS item_count
  FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) lc
    ON o.o_orderkey = lc.l_orderkey
),
cr_base AS (
  SELECT 'cr-' || c.c_custkey AS event_id, TIMESTAMP '1994-12-31 00:00:00' AS event_timestamp,
         '1.0' AS event_version, 'cust-' || c.c_custkey AS customer_id, c.c_name AS customer_name,
         'c' || c.c_custkey || '@example.com' AS email, n.n_name AS state,
         c.c_custkey AS k, '199412-customers.ndjson' AS f
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
cu_base AS (
  SELECT 'cu-' || event_id AS event_id, date_trunc('second', ts) AS event_timestamp,
         '1.0' AS event_version, 'cust-' || user_id AS customer_id,
         CASE WHEN event_type = 'signup' THEN 'email' ELSE 'state' END AS field_changed,
         'prev' AS old_value,
         CASE WHEN event_type = 'signup' THEN 'u' || event_id || '@example.com'
              ELSE 'NATION_' || (event_id % 25) END AS new_value,
         event_id AS k, strftime(ts, '%Y%m') || '-updates.ndjson' AS f
  FROM events WHERE event_type IN ('signup', 'view')
),
oc_base AS (
  SELECT 'oc-' || o_orderkey AS event_id, created_at AS event_timestamp, '1.0' AS event_version,
         'ord-' || o_orderkey AS order_id, 'cust-' || o_custkey AS customer_id,
         CAST(o_totalprice AS DECIMAL(10,2)) AS amount, 'BRL' AS currency, item_count,
         o_orderkey AS k, strftime(created_at, '%Y%m') || '-orders.ndjson' AS f
  FROM ob
),
legs AS (
  SELECT o_orderkey, 'paid' AS new_status, 'created' AS old_status,
         created_at + to_minutes(CAST((o_orderkey % 72) * 60 + 30 AS BIGINT)) AS changed_at
  FROM ob WHERE o_orderkey % 5 <> 0
  UNION ALL
  SELECT o_orderkey, 'shipped', 'paid', created_at + to_minutes(CAST((72 + o_orderkey % 200) * 60 AS BIGINT))
  FROM ob WHERE o_orderkey % 5 <> 0 AND o_orderstatus IN ('F', 'P')
  UNION ALL
  SELECT o_orderkey, 'delivered', 'shipped', created_at + to_minutes(CAST((300 + o_orderkey % 300) * 60 AS BIGINT))
  FROM ob WHERE o_orderkey % 5 <> 0 AND o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, 'canceled', 'created', created_at + to_minutes(CAST((o_orderkey % 48) * 60 AS BIGINT))
  FROM ob WHERE o_orderkey % 10 = 0
),
sc_base AS (
  SELECT 'sc-' || o_orderkey || '-' || new_status AS event_id, changed_at AS event_timestamp,
         '1.0' AS event_version, 'ord-' || o_orderkey AS order_id, old_status, new_status,
         o_orderkey AS k, strftime(changed_at, '%Y%m') || '-status.ndjson' AS f
  FROM legs
),
tele AS (
  SELECT 'ev-' || event_id AS event_id, event_type, event_type = 'error' AS bad,
         'events/telemetry-' || strftime(ts, '%Y%m%d-%H') || '.ndjson' AS _source_file
  FROM events WHERE event_type IN ('click', 'purchase', 'error')
),
{_silver("dt_customers_registered", "cr_base",
         "event_id, event_timestamp, event_version, customer_id, customer_name, email, state")},
{_silver("dt_customers_updated", "cu_base",
         "event_id, event_timestamp, event_version, customer_id, field_changed, old_value, new_value")},
{_silver("dt_orders_created", "oc_base",
         "event_id, event_timestamp, event_version, order_id, customer_id, amount, currency, item_count")},
{_silver("dt_orders_status_changed", "sc_base",
         "event_id, event_timestamp, event_version, order_id, old_status, new_status")},
stg_orders_created AS (
  SELECT event_id, order_id, customer_id, event_timestamp AS created_at, amount, currency,
         item_count, _ingested_at AS ingested_at FROM dt_orders_created
),
stg_orders_status_changed AS (
  SELECT event_id, order_id, event_timestamp AS changed_at, old_status, new_status,
         _ingested_at AS ingested_at FROM dt_orders_status_changed
),
stg_customers_registered AS (
  SELECT event_id, customer_id, event_timestamp AS registered_at, customer_name, email, state,
         _ingested_at AS ingested_at FROM dt_customers_registered
),
stg_customers_updated AS (
  SELECT event_id, customer_id, event_timestamp AS updated_at, field_changed, old_value, new_value,
         _ingested_at AS ingested_at FROM dt_customers_updated
)"""


def _calendar(spine: str) -> str:
    """Calendar attributes over a CTE/subquery with one DATE column ``d``."""
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(quarter(d) AS INTEGER) AS quarter,
         CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semester,
         CAST(dayofweek(d) AS INTEGER) AS day_of_week_number,
         rpad(dayname(d), 9, ' ') AS day_name_full, strftime(d, '%a') AS day_name_short,
         rpad(monthname(d), 9, ' ') AS month_name_full, strftime(d, '%b') AS month_name_short,
         dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday,
         day(d) = 1 AS is_first_day_of_month, d = last_day(d) AS is_last_day_of_month,
         CAST(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
         CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date,
         strftime(d, '%Y-%m') AS year_month, year(d) || '-' || quarter(d) AS year_quarter
  FROM {spine}"""


GOLD = f"""
cu_ranked AS (
  SELECT customer_id, field_changed, new_value, updated_at,
         row_number() OVER (PARTITION BY customer_id, field_changed
                            ORDER BY updated_at DESC NULLS LAST, event_id DESC) AS pos
  FROM stg_customers_updated WHERE field_changed IN ('email', 'state')
),
cu_pivot AS (
  SELECT customer_id,
         max(new_value) FILTER (WHERE field_changed = 'email') AS new_email,
         max(updated_at) FILTER (WHERE field_changed = 'email') AS email_at,
         count(*) FILTER (WHERE field_changed = 'email') AS n_email,
         max(new_value) FILTER (WHERE field_changed = 'state') AS new_state,
         max(updated_at) FILTER (WHERE field_changed = 'state') AS state_at,
         count(*) FILTER (WHERE field_changed = 'state') AS n_state
  FROM cu_ranked WHERE pos = 1 GROUP BY customer_id
),
dim_customers AS (
  SELECT md5(r.customer_id) AS customer_sk, r.customer_id, r.customer_name,
         coalesce(p.new_email, r.email) AS email, coalesce(p.new_state, r.state) AS state,
         r.registered_at,
         CASE WHEN r.registered_at IS NOT NULL THEN greatest(r.registered_at,
              coalesce(p.email_at, r.registered_at), coalesce(p.state_at, r.registered_at)) END
           AS last_updated_at,
         coalesce(p.n_email + p.n_state > 0, false) AS has_been_updated
  FROM stg_customers_registered r LEFT JOIN cu_pivot p ON r.customer_id = p.customer_id
),
dim_date AS ({_calendar(f"(SELECT CAST(unnest(generate_series(DATE '{CAL_START}', DATE '{CAL_END}', INTERVAL 1 DAY)) AS DATE) AS d)")}
),
sc_ranked AS (
  SELECT order_id, new_status, changed_at,
         row_number() OVER (PARTITION BY order_id ORDER BY changed_at DESC NULLS LAST, event_id DESC) AS newest,
         row_number() OVER (PARTITION BY order_id, new_status ORDER BY changed_at ASC NULLS LAST) AS first_in
  FROM stg_orders_status_changed
),
sc_pivot AS (
  SELECT order_id,
         max(new_status) FILTER (WHERE newest = 1) AS current_status,
         max(changed_at) FILTER (WHERE newest = 1) AS last_status_changed_at,
         max(changed_at) FILTER (WHERE first_in = 1 AND new_status = 'paid') AS paid_at,
         max(changed_at) FILTER (WHERE first_in = 1 AND new_status = 'shipped') AS shipped_at,
         max(changed_at) FILTER (WHERE first_in = 1 AND new_status = 'delivered') AS delivered_at
  FROM sc_ranked GROUP BY order_id
),
fct_orders AS (
  SELECT md5(o.order_id) AS order_sk, o.order_id, md5(o.customer_id) AS customer_sk,
         CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
         CAST(strftime(p.paid_at, '%Y%m%d') AS INTEGER) AS paid_date_key,
         CAST(strftime(p.shipped_at, '%Y%m%d') AS INTEGER) AS shipped_date_key,
         CAST(strftime(p.delivered_at, '%Y%m%d') AS INTEGER) AS delivered_date_key,
         coalesce(p.current_status, 'created') AS current_status,
         o.amount AS order_amount, o.currency, o.item_count,
         o.created_at, p.paid_at, p.shipped_at, p.delivered_at, p.last_status_changed_at,
         CAST(date_diff('day', o.created_at, p.paid_at) AS INTEGER) AS days_to_paid,
         CAST(date_diff('day', o.created_at, p.shipped_at) AS INTEGER) AS days_to_shipped,
         CAST(date_diff('day', o.created_at, p.delivered_at) AS INTEGER) AS days_to_delivered,
         p.delivered_at IS NOT NULL AS is_delivered,
         coalesce(p.current_status IN ('delivered', 'canceled'), false) AS is_completed
  FROM stg_orders_created o LEFT JOIN sc_pivot p ON o.order_id = p.order_id
),
fct_order_lifecycle AS (
  SELECT md5(sc.event_id) AS lifecycle_sk, sc.event_id, sc.order_id, md5(o.order_id) AS order_sk,
         md5(o.customer_id) AS customer_sk,
         CAST(strftime(sc.changed_at, '%Y%m%d') AS INTEGER) AS changed_date_key,
         CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
         sc.old_status, sc.new_status, sc.changed_at, o.created_at AS order_created_at,
         CAST(date_diff('day', o.created_at, sc.changed_at) AS INTEGER) AS days_since_creation,
         CAST(date_diff('hour', o.created_at, sc.changed_at) AS INTEGER) AS hours_since_creation,
         o.customer_id, o.amount AS order_amount, o.currency, o.item_count
  FROM stg_orders_status_changed sc INNER JOIN stg_orders_created o ON sc.order_id = o.order_id
),
mart_daily_revenue AS (
  SELECT d.date_key AS day_date_key, d.full_date AS day_date, d.year_month, d.day_name_short,
         d.is_weekend, c.state AS customer_state,
         count(DISTINCT o.order_id) AS orders_count,
         count(DISTINCT o.customer_sk) AS unique_customers,
         CAST(sum(o.order_amount) AS DECIMAL(20,2)) AS gross_revenue,
         CAST(sum(o.order_amount) AS DOUBLE) / count(o.order_amount) AS avg_order_value,
         min(o.order_amount) AS min_order_value, max(o.order_amount) AS max_order_value,
         CAST(sum(o.item_count) AS BIGINT) AS total_items_sold,
         CAST(sum(o.item_count) AS DOUBLE) / count(o.item_count) AS avg_items_per_order,
         CAST(sum(CASE WHEN o.is_completed THEN 1 ELSE 0 END) AS BIGINT) AS completed_orders,
         CAST(sum(CASE WHEN o.is_delivered THEN 1 ELSE 0 END) AS BIGINT) AS delivered_orders,
         CAST(sum(CASE WHEN o.is_completed THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS completion_rate,
         CAST(sum(CASE WHEN o.is_delivered THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS delivery_rate
  FROM fct_orders o
  INNER JOIN dim_customers c ON o.customer_sk = c.customer_sk
  INNER JOIN dim_date d ON o.created_date_key = d.date_key
  GROUP BY 1, 2, 3, 4, 5, 6
),
mart_order_funnel AS (
  SELECT CAST(CASE current_status WHEN 'created' THEN 1 WHEN 'paid' THEN 2 WHEN 'shipped' THEN 3
              WHEN 'delivered' THEN 4 WHEN 'canceled' THEN 5 ELSE 99 END AS INTEGER) AS funnel_step,
         current_status AS status_name, count(*) AS orders_count,
         CAST(sum(order_amount) AS DECIMAL(20,2)) AS revenue_in_status,
         round(CAST(sum(order_amount) AS DOUBLE) / count(order_amount), 2) AS avg_amount,
         round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS pct_of_total
  FROM fct_orders GROUP BY current_status
),
dim_products AS (
  SELECT * FROM read_csv('{SEED}', header = true,
    columns = {{'product_id': 'VARCHAR', 'product_name': 'VARCHAR', 'category': 'VARCHAR',
               'unit_price': 'DECIMAL(10,2)', 'is_active': 'BOOLEAN'}})
)"""


def _with(final: str) -> str:
    return f"WITH {FIXTURE},{GOLD}\n{final}"


SILVER_COLS = {
    "orders_created": "dt_orders_created",
    "orders_status_changed": "dt_orders_status_changed",
    "customers_registered": "dt_customers_registered",
    "customers_updated": "dt_customers_updated",
}


def _lit(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(v)
    return "'" + str(v).replace("'", "''") + "'"


def _check_sql(c: Check) -> str:
    head = f"SELECT '{c.relation}' AS relation, '{c.column}' AS column_name, '{c.test}' AS test, "
    col, rel = c.column, c.relation
    if c.test == "unique":
        return head + (
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {rel} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"
        )
    if c.test == "not_null":
        return head + f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {rel}"
    if c.test == "accepted_values":
        vals = ", ".join(_lit(v) for v in c.values)
        return head + (
            f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {col} FROM {rel} "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col})"
        )
    return head + (
        f"CAST(count(*) AS BIGINT) AS failures FROM {rel} ch WHERE ch.{col} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {c.to} p WHERE p.{c.field} = ch.{col})"
    )


def quality_sql(test: str) -> str:
    parts = [_check_sql(c) for c in SUITE if c.test == test]
    return _with("\nUNION ALL\n".join(parts))


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # Bronze
    bronze_rows = """
  SELECT event_id, 'customer_registered' AS event_type, 'events/events-' || f AS _source_file, {T0} AS _ingested_at FROM cr_base
  UNION ALL SELECT event_id, 'customer_updated', 'events/events-' || f, {T0} FROM cu_base
  UNION ALL SELECT event_id, 'order_created', 'events/events-' || f, {T0} FROM oc_base
  UNION ALL SELECT event_id, 'order_status_changed', 'events/events-' || f, {T0} FROM sc_base
  UNION ALL SELECT event_id, 'customer_registered', 'events/retry/events-' || f, {T1} FROM cr_base WHERE k % 10 = 0
  UNION ALL SELECT event_id, 'customer_updated', 'events/retry/events-' || f, {T1} FROM cu_base WHERE k % 10 = 0
  UNION ALL SELECT event_id, 'order_created', 'events/retry/events-' || f, {T1} FROM oc_base WHERE k % 10 = 0
  UNION ALL SELECT event_id, 'order_status_changed', 'events/retry/events-' || f, {T1} FROM sc_base WHERE k % 10 = 0
""".format(T0=T0, T1=T1)
    tele_files = """
tele_files AS (
  SELECT _source_file, count(*) AS total_lines, count(*) FILTER (WHERE bad) AS bad_lines FROM tele GROUP BY 1
)"""
    q["bronze_load"] = _with(f""", {tele_files[1:]}
SELECT * FROM ({bronze_rows}) b
UNION ALL
SELECT t.event_id, t.event_type, t._source_file, {T0} FROM tele t
JOIN tele_files f ON t._source_file = f._source_file
WHERE NOT t.bad AND f.bad_lines * 10 <= f.total_lines""")
    q["bronze_reject_gate"] = _with(f""", {tele_files[1:]}
SELECT _source_file, CAST(count(*) AS BIGINT) AS total_lines, CAST(0 AS BIGINT) AS bad_lines,
       CAST(0.0 AS DOUBLE) AS bad_ratio, true AS loaded
FROM ({bronze_rows}) b GROUP BY _source_file
UNION ALL
SELECT _source_file, total_lines, bad_lines,
       CAST(bad_lines AS DOUBLE) / CAST(total_lines AS DOUBLE) AS bad_ratio,
       bad_lines * 10 <= total_lines AS loaded
FROM tele_files""")
    # Silver and staging
    for name, dt in SILVER_COLS.items():
        q[f"silver_{name}"] = _with(f"SELECT * FROM {dt}")
        q[f"stg_{name}"] = _with(f"SELECT * FROM stg_{name}")
    q["stream_silver_orders_created"] = _with(
        "SELECT event_id, event_timestamp, event_version, order_id, customer_id, amount, "
        "currency, item_count, _source_file FROM dt_orders_created"
    )
    for name in ("orders_status_changed", "customers_registered", "customers_updated"):
        q[f"stream_ingest_{name}"] = _with(f"SELECT * EXCLUDE (_ingested_at) FROM {SILVER_COLS[name]}")
    q["stream_replay_compact_refresh"] = _with(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, event_id, _source_file, _ingested_at FROM {dt}"
        for name, dt in SILVER_COLS.items()
    ))
    # three streams: the first delivery once, the redelivery twice in Bronze, all once in Silver
    q["stream_two_sources"] = _with(" UNION ALL ".join(
        [f"SELECT 'bronze' AS table_name, event_id, 'events/events-' || f AS _source_file FROM {b} "
         f"UNION ALL SELECT 'bronze', event_id, 'events/retry/events-' || f FROM {b}, (VALUES (1), (2)) AS twice(n) WHERE k % 10 = 0"
         for b in ("cr_base", "cu_base", "oc_base", "sc_base")]
        + [f"SELECT '{name}', event_id, _source_file FROM {dt}" for name, dt in SILVER_COLS.items()]
    ))
    q["notified_ingest_orders"] = _with(
        "SELECT event_id, event_timestamp, event_version, order_id, customer_id, amount, currency, item_count FROM dt_orders_created")
    # the first run refreshes; a tenth of the events redelivered is less than half of what is stored
    q["silver_refresh_auto"] = _with(" UNION ALL ".join(
        [f"SELECT 'choice {i}' AS table_name, '{name}: {mode}' AS event_id, NULL AS _source_file"
         for i, mode in enumerate(("full", "incremental", "incremental")) for name in SILVER_COLS]
        + [f"SELECT '{name}', event_id, _source_file FROM {dt}" for name, dt in SILVER_COLS.items()]
    ))
    q["silver_quarantine"] = _with(
        "SELECT event_id, CASE WHEN k % 7 <> 0 THEN amount END AS amount, k % 7 = 0 AS set_aside FROM oc_base")
    q["gold_build_published"] = _with("SELECT *, true AS audited, true AS in_earlier_build FROM fct_orders")
    # Gold
    q["dim_customers"] = _with("SELECT * FROM dim_customers")
    span = (
        "(SELECT CAST(unnest(generate_series(min(created_at)::DATE, max(created_at)::DATE, "
        "INTERVAL 1 DAY)) AS DATE) AS d FROM stg_orders_created)"
    )
    q["dim_date"] = _with(_calendar(span))
    q["fct_orders"] = _with("SELECT * FROM fct_orders")
    q["fct_order_lifecycle"] = _with("SELECT * FROM fct_order_lifecycle")
    q["mart_daily_revenue"] = _with("SELECT * FROM mart_daily_revenue")
    q["mart_order_funnel"] = _with("SELECT * FROM mart_order_funnel ORDER BY funnel_step, status_name")
    # Quality
    for t in ("unique", "not_null", "accepted_values", "relationships"):
        q[f"dq_{t}"] = quality_sql(t)
    repeated = "(SELECT {0} FROM {1} GROUP BY {0} HAVING count(*) > 1)"
    q["dq_violations"] = _with(f"""
SELECT 'delivered_orders_created' AS relation, 'event_id' AS column_name, 'unique' AS test, count(*) AS failures
FROM oc_base WHERE k % 10 = 0
UNION ALL SELECT 'fct_order_lifecycle', 'order_id', 'unique', count(*) FROM {repeated.format("order_id", "fct_order_lifecycle")}
UNION ALL SELECT 'fct_orders', 'customer_sk', 'unique', count(*) FROM {repeated.format("customer_sk", "fct_orders")}
UNION ALL SELECT 'fct_orders', 'paid_at', 'not_null', count(*) FROM fct_orders WHERE paid_at IS NULL
UNION ALL SELECT 'fct_orders', 'delivered_at', 'not_null', count(*) FROM fct_orders WHERE delivered_at IS NULL
UNION ALL SELECT 'fct_orders', 'current_status', 'accepted_values',
  count(DISTINCT current_status) FROM fct_orders WHERE current_status NOT IN ('created', 'delivered')
UNION ALL SELECT 'fct_order_lifecycle', 'old_status', 'accepted_values',
  count(DISTINCT old_status) FROM fct_order_lifecycle WHERE old_status <> 'created'
UNION ALL SELECT 'fct_order_lifecycle', 'new_status', 'accepted_values',
  count(DISTINCT new_status) FROM fct_order_lifecycle WHERE new_status NOT IN ('paid', 'shipped', 'delivered')
UNION ALL SELECT 'fct_order_lifecycle', 'changed_date_key', 'relationships', count(*)
FROM fct_order_lifecycle c ANTI JOIN dim_date d ON c.changed_date_key = d.date_key""")
    # Questions
    q["avg_days_to_delivery"] = _with("""
SELECT count(days_to_delivered) AS delivered_orders,
       CAST(sum(days_to_delivered) AS DOUBLE) / count(days_to_delivered) AS avg_days_to_delivery,
       min(days_to_delivered) AS min_days_to_delivery, max(days_to_delivered) AS max_days_to_delivery
FROM fct_orders""")
    q["aov_by_state"] = _with("""
SELECT c.state AS customer_state, count(*) AS orders_count,
       CAST(sum(o.order_amount) AS DECIMAL(20,2)) AS revenue,
       CAST(sum(o.order_amount) AS DOUBLE) / count(o.order_amount) AS avg_order_value
FROM fct_orders o JOIN dim_customers c ON o.customer_sk = c.customer_sk
GROUP BY c.state""")
    q["transition_gaps"] = _with("""
, gaps AS (
  SELECT l.old_status, l.new_status,
         CAST(date_diff('hour',
              CASE WHEN l.old_status = 'created' THEN l.order_created_at
                   ELSE (SELECT min(p.changed_at) FROM fct_order_lifecycle p
                         WHERE p.order_id = l.order_id AND p.new_status = l.old_status) END,
              l.changed_at) AS INTEGER) AS gap_hours
  FROM fct_order_lifecycle l
)
SELECT old_status, new_status, count(*) AS transitions, count(gap_hours) AS timed_transitions,
       CAST(sum(gap_hours) AS DOUBLE) / count(gap_hours) AS avg_gap_hours,
       min(gap_hours) AS min_gap_hours, max(gap_hours) AS max_gap_hours
FROM gaps GROUP BY 1, 2""")
    q["status_transitions"] = _with("""
, pairs AS (
  SELECT old_status, new_status, count(*) AS transitions, count(DISTINCT order_id) AS orders
  FROM fct_order_lifecycle GROUP BY 1, 2
)
SELECT old_status, new_status, transitions, orders,
       round(CAST(transitions AS DOUBLE) / CAST(sum(transitions) OVER (PARTITION BY old_status) AS DOUBLE), 4)
         AS share_of_exits
FROM pairs""")
    q["changes_over_time"] = _with("""
SELECT strftime(changed_at, '%Y-%m') AS year_month, new_status, count(*) AS changes,
       count(DISTINCT order_id) AS orders
FROM fct_order_lifecycle WHERE changed_at IS NOT NULL GROUP BY 1, 2""")
    q["revenue_seasonality"] = _with("""
SELECT customer_state, day_name_short, is_weekend,
       CAST(sum(orders_count) AS BIGINT) AS orders_count,
       CAST(sum(gross_revenue) AS DECIMAL(30,2)) AS gross_revenue,
       CAST(sum(total_items_sold) AS BIGINT) AS total_items_sold,
       CAST(sum(gross_revenue) AS DOUBLE) / CAST(sum(orders_count) AS DOUBLE) AS avg_order_value
FROM mart_daily_revenue GROUP BY 1, 2, 3""")
    q["revenue_by_month"] = _with("""
SELECT customer_state, year_month,
       CAST(sum(orders_count) AS BIGINT) AS orders_count,
       CAST(sum(gross_revenue) AS DECIMAL(30,2)) AS gross_revenue,
       CAST(sum(completed_orders) AS BIGINT) AS completed_orders,
       CAST(sum(gross_revenue) AS DOUBLE) / CAST(sum(orders_count) AS DOUBLE) AS avg_order_value
FROM mart_daily_revenue GROUP BY 1, 2""")
    q["unique_customers_by_month"] = _with("""
SELECT c.state AS customer_state, strftime(o.created_at, '%Y-%m') AS year_month, count(DISTINCT o.customer_sk) AS unique_customers
FROM fct_orders o JOIN dim_customers c ON o.customer_sk = c.customer_sk WHERE o.created_at IS NOT NULL GROUP BY 1, 2""")
    q["revenue_by_status"] = _with("""
SELECT funnel_step, status_name, orders_count, revenue_in_status FROM mart_order_funnel
WHERE status_name NOT IN ('delivered', 'canceled')""")
    return q
