"""The expected results as SQL on the tables themselves.

Written from the rules, not from the operators: no message, no JSON, no stream. DuckDB
counts days from Sunday = 0 and has wider integer results, hence the casts.
"""

from __future__ import annotations

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"

_ORDERS = f"""
o AS (
  SELECT *,
    CAST(subtotal_d AS DOUBLE) AS subtotal,
    round(subtotal_d * CAST(1 - discount_d AS DECIMAL(4,2)), 2) AS total_d
  FROM (
    SELECT event_id AS id, user_id AS uid, ts, value, {_K} AS k,
      CAST(event_id % 5 + 1 AS INTEGER) AS quantity,
      CAST((event_id % 31) * 0.01 AS DECIMAL(4,2)) AS discount_d,
      CAST(CAST(value AS DECIMAL(12,2)) * CAST(event_id % 5 + 1 AS DECIMAL(2,0))
        AS DECIMAL(14,2)) AS subtotal_d,
      ['Electronics','Sports','Kitchen','Home','Health'][{_K} % 5 + 1] AS category,
      ['New York','Los Angeles','Chicago','Houston','Phoenix','Philadelphia',
       'San Antonio','San Diego','Dallas','San Jose'][{_K} % 10 + 1] AS city,
      ['mobile','desktop','tablet'][{_K} % 3 + 1] AS device,
      CASE WHEN value < 25 THEN 'budget' WHEN value < 75 THEN 'mid'
        ELSE 'premium' END AS price_tier
    FROM events WHERE event_type = 'purchase'))"""

_CLICKS = f"""
c AS (
  SELECT event_id AS id, user_id AS uid, ts, {_K} AS k,
    CAST(floor(value) AS INTEGER) AS time_on_page,
    CASE WHEN floor(value) < 10 THEN 'bounce' WHEN floor(value) < 60 THEN 'low'
      WHEN floor(value) < 180 THEN 'medium' ELSE 'high' END AS engagement
  FROM events WHERE event_type IN ('click', 'view'))"""

_PAYMENTS = f"""
p AS (
  SELECT event_id AS id, user_id AS uid, ts, {_K} AS k,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN event_type = 'error' THEN
      ['insufficient_funds','card_expired','declined'][{_K} % 3 + 1] END AS failure_reason,
    CAST(round(CAST(value AS DECIMAL(12,2)) * CAST(event_id % 3 + 1 AS DECIMAL(2,0)), 2)
      AS DOUBLE) AS amount,
    ['credit_card','debit_card','paypal','apple_pay','google_pay'][{_K} % 5 + 1]
      AS payment_method
  FROM events WHERE event_type IN ('signup', 'error'))"""

_WITH_ORDERS = f"WITH {_ORDERS}"
_WITH_CLICKS = f"WITH {_CLICKS}"
_WITH_PAYMENTS = f"WITH {_PAYMENTS}"

_TOPIC = """CASE WHEN event_type = 'purchase' THEN 'ecommerce.orders'
  WHEN event_type IN ('click', 'view') THEN 'ecommerce.clicks'
  ELSE 'ecommerce.payments' END"""

_KNOWN = "event_type IN ('purchase', 'click', 'view', 'signup', 'error')"

_TIMES = """ts AS event_ts, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
  dayofweek(ts) IN (0, 6) AS is_weekend"""

_CITY = """['New York','Los Angeles','Chicago','Houston','Phoenix','Philadelphia',
  'San Antonio','San Diego','Dallas','San Jose'][k % 10 + 1] AS city"""
_DEVICE = "['mobile','desktop','tablet'][k % 3 + 1] AS device"

_TIERS = f"""{_WITH_ORDERS}
SELECT price_tier, count(*) AS orders, CAST(sum(total_d) AS DOUBLE) AS revenue
FROM o GROUP BY price_tier"""

_KPIS = f"""{_WITH_ORDERS},
t AS (
  SELECT count(*) FILTER (event_type = 'purchase') AS total_orders,
    count(*) FILTER (event_type IN ('click', 'view')) AS total_clicks,
    count(*) FILTER (event_type IN ('signup', 'error')) AS total_payments,
    count(*) FILTER (event_type = 'error') AS failed_payments
  FROM events),
kpi AS (
  SELECT total_orders, total_clicks, total_payments,
    coalesce((SELECT CAST(sum(total_d) AS DOUBLE) FROM o), 0.0) AS total_revenue,
    failed_payments,
    round_even((1 - failed_payments / greatest(total_payments, 1)) * 100, 1)
      AS payment_success_rate
  FROM t)"""


def _breakdowns(category: str, city: str, device: str, method: str, total: str) -> str:
    """Panels of all breakdowns, given the label and amount of each event."""
    panels = [
        f"SELECT '{panel}' AS panel, {label} AS label, count(*) AS events, "
        f"CAST(sum({total}) AS DOUBLE) AS revenue FROM o GROUP BY ALL"
        for panel, label in (("category", category), ("city", city), ("device", device))
    ]
    panels.append(
        f"SELECT 'payment_method' AS panel, {method} AS label, count(*) AS events, "
        "0.0::DOUBLE AS revenue FROM p GROUP BY ALL"
    )
    return f"WITH {_ORDERS}, {_PAYMENTS}\n" + "\nUNION ALL\n".join(panels)


_BREAKDOWNS = _breakdowns("category", "city", "device", "payment_method", "total_d")

_HOURS = f"""{_WITH_ORDERS},
seen AS (
  SELECT date_trunc('hour', ts) AS cycle_start FROM events WHERE {_KNOWN}),
span AS (SELECT min(cycle_start) AS first, max(cycle_start) AS last FROM seen),
line AS (
  SELECT unnest(generate_series(greatest(first, last - INTERVAL 59 HOUR), last,
    INTERVAL 1 HOUR)) AS cycle_start FROM span),
series AS (
  SELECT line.cycle_start, count(o.id) AS orders,
    coalesce(CAST(sum(o.total_d) AS DOUBLE), 0.0) AS revenue
  FROM line LEFT JOIN o ON date_trunc('hour', o.ts) = line.cycle_start
  GROUP BY line.cycle_start)"""

def _top_cities(city: str) -> str:
    return f"""{_WITH_ORDERS}
SELECT city, revenue, CAST(row_number() OVER (ORDER BY total DESC, city) AS INTEGER) AS rank
FROM (SELECT {city} AS city, sum(total_d) AS total, CAST(sum(total_d) AS DOUBLE) AS revenue
  FROM o GROUP BY ALL)
ORDER BY total DESC, city LIMIT 10"""


_HOURLY = f"""{_WITH_ORDERS}
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM o GROUP BY 1, 2"""

_PER_PART = f"""{_WITH_ORDERS},
part AS (
  SELECT CAST(id % 4 AS BIGINT) AS batch_id, count(*) AS orders,
    CAST(sum(total_d) AS DOUBLE) AS revenue
  FROM o GROUP BY 1)"""

_HOLED = f"""
WITH placed AS (
  SELECT {_TOPIC} AS topic, CAST(event_id % 4 AS INTEGER) AS partition,
    CAST(event_id // 4 AS BIGINT) AS "offset"
  FROM events WHERE {_KNOWN}),
log AS (
  SELECT * FROM placed WHERE "offset" % 50 > 2 AND "offset" NOT BETWEEN 300 AND 700)"""

ORACLE_SQL: dict[str, str] = {
    "offset_gaps": f"""{_HOLED},
following AS (
  SELECT *, lead("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS later
  FROM (SELECT DISTINCT * FROM log))
SELECT topic, partition, "offset" + 1 AS first_missing, later - 1 AS last_missing,
  later - "offset" - 1 AS missing
FROM following WHERE later > "offset" + 1""",
    "offset_coverage": f"""{_HOLED}
SELECT topic, partition, min("offset") AS first_offset, max("offset") AS last_offset,
  count(DISTINCT "offset") AS present,
  max("offset") - min("offset") + 1 - count(DISTINCT "offset") AS missing,
  count(*) + count(*) FILTER ("offset" % 7 = 0) - count(DISTINCT "offset") AS repeated
FROM log GROUP BY 1, 2""",
    "envelope_topic_counts": f"""
SELECT {_TOPIC} AS topic, count(*) AS n FROM events WHERE {_KNOWN} GROUP BY 1""",
    "publish_frame": f"""
SELECT 'U' || user_id AS key, {_TOPIC} AS topic, count(*) AS n
FROM events WHERE {_KNOWN} GROUP BY 1, 2""",
    "publish_payloads": f"""
SELECT kind AS event_type, topic, n AS event_id, n AS timestamp, n AS user_id,
  if(kind = 'payment', 0, n) AS session_id,
  if(kind = 'click', 0, n) AS order_id,
  if(kind = 'payment', 0, n) AS product_id,
  if(kind = 'payment', 0, n) AS product_name,
  if(kind = 'payment', 0, n) AS category,
  if(kind = 'order', n, 0) AS quantity,
  if(kind = 'order', n, 0) AS unit_price,
  if(kind = 'order', n, 0) AS discount,
  if(kind = 'order', n, 0) AS subtotal,
  if(kind = 'order', n, 0) AS total_amount,
  if(kind = 'click', 0, n) AS currency,
  if(kind = 'click', 0, n) AS status,
  n AS city, n AS device,
  if(kind = 'click', n, 0) AS page,
  if(kind = 'click', n, 0) AS os,
  if(kind = 'click', n, 0) AS browser,
  if(kind = 'click', n, 0) AS time_on_page,
  if(kind = 'payment', n, 0) AS payment_id,
  if(kind = 'payment', n, 0) AS amount,
  if(kind = 'payment', n, 0) AS payment_method,
  failed AS failure_reason
FROM (
  SELECT {_TOPIC} AS topic,
    CASE WHEN event_type = 'purchase' THEN 'order'
      WHEN event_type IN ('click', 'view') THEN 'click' ELSE 'payment' END AS kind,
    count(*) AS n, count(*) FILTER (event_type = 'error') AS failed
  FROM events WHERE {_KNOWN} GROUP BY 1, 2)""",
    "payload_routing": f"""{_KPIS}
SELECT total_orders, total_clicks, failed_payments AS total_payments, total_revenue,
  failed_payments, 0.0::DOUBLE AS payment_success_rate
FROM kpi""",
    "throughput": f"""
SELECT events, seconds, events / seconds AS rate FROM (
  SELECT count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6::DOUBLE AS seconds
  FROM events WHERE {_KNOWN})""",
    "orders_enriched": f"""{_WITH_ORDERS}
SELECT 'order' AS event_type, CAST(id AS VARCHAR) AS event_id, 'U' || uid AS user_id,
  'S' || uid AS session_id, 'ORD-' || id AS order_id, 'P' || k AS product_id,
  'Product ' || k AS product_name, category, quantity, value AS unit_price,
  CAST(discount_d AS DOUBLE) AS discount, subtotal, CAST(total_d AS DOUBLE) AS total_amount,
  'USD' AS currency, ['pending','confirmed','processing'][k % 3 + 1] AS status, city, device,
  {_TIMES}, price_tier
FROM o""",
    "clicks_enriched": f"""{_WITH_CLICKS}
SELECT 'click' AS event_type, CAST(id AS VARCHAR) AS event_id, 'U' || uid AS user_id,
  'S' || uid AS session_id, 'P' || k AS product_id, 'Product ' || k AS product_name,
  ['Electronics','Sports','Kitchen','Home','Health'][k % 5 + 1] AS category,
  ['home','search','category','product','cart'][k % 5 + 1] AS page, {_DEVICE},
  ['iOS','Android','Windows','macOS'][k % 4 + 1] AS os,
  ['Chrome','Safari','Firefox','Edge'][k % 4 + 1] AS browser, {_CITY}, time_on_page,
  {_TIMES}, engagement
FROM c""",
    "payments_enriched": f"""{_WITH_PAYMENTS}
SELECT 'payment' AS event_type, CAST(id AS VARCHAR) AS event_id, 'U' || uid AS user_id,
  'ORD-' || id AS order_id, 'PAY-' || id AS payment_id, amount, 'USD' AS currency,
  payment_method, status, failure_reason, {_CITY}, {_DEVICE},
  {_TIMES}, status = 'success' AS is_successful
FROM p""",
    "orders_by_price_tier": _TIERS,
    "clicks_by_engagement": f"""{_WITH_CLICKS}
SELECT engagement, count(*) AS clicks FROM c GROUP BY 1""",
    "payments_by_outcome": f"""{_WITH_PAYMENTS}
SELECT status, status = 'success' AS is_successful, failure_reason, count(*) AS payments
FROM p GROUP BY ALL""",
    "partition_counts": f"""
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM events WHERE {_KNOWN} GROUP BY 1, 2""",
    "weekend_activity": f"""{_WITH_ORDERS}
SELECT dayofweek(ts) IN (0, 6) AS is_weekend, count(*) AS orders,
  CAST(sum(total_d) AS DOUBLE) AS revenue
FROM o GROUP BY 1""",
    "late_event_partitions": f"""{_WITH_ORDERS}
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS events,
  count(*) FILTER (CAST(ts + to_hours(CAST(id % 49 AS INTEGER)) AS DATE) > CAST(ts AS DATE))
    AS late_events
FROM o GROUP BY 1""",
    "bad_records": f"""{_WITH_ORDERS}
SELECT variant, count(*) AS n,
  CASE WHEN variant IN (1, 2, 3, 4) THEN 0 ELSE count(*) END AS with_event_id,
  CASE WHEN variant IN (1, 2, 3, 4, 5) THEN 0 ELSE count(*) END AS with_quantity,
  CASE WHEN variant IN (1, 2, 3, 4, 6) THEN 0 ELSE count(*) END AS with_price,
  CASE WHEN variant IN (1, 2, 3, 4) THEN count(*) ELSE 0 END AS without_date,
  CASE WHEN variant IN (1, 2, 3, 4, 6) THEN count(*)
    ELSE count(*) FILTER (price_tier = 'premium') END AS premium,
  CASE WHEN variant BETWEEN 1 AND 6 THEN count(*) ELSE 0 END AS rejected,
  CASE WHEN variant IN (1, 2, 3, 5, 6) THEN count(*) ELSE 0 END AS with_rejected_text
FROM (SELECT *, CAST(id % 8 AS INTEGER) AS variant FROM o) GROUP BY variant""",
    "reject_reasons": f"""{_WITH_ORDERS}
SELECT variant, CASE variant WHEN 1 THEN 'not json' WHEN 2 THEN 'no object' WHEN 3 THEN 'empty'
    WHEN 4 THEN 'null' ELSE 'wrong type' END AS reason,
  CASE variant WHEN 5 THEN 'quantity' WHEN 6 THEN 'unit_price' END AS field,
  CASE variant WHEN 5 THEN 'int' WHEN 6 THEN 'double' END AS expected,
  CASE WHEN variant IN (5, 6) THEN 'string' END AS found, count(*) AS n,
  CAST(sum(CASE variant WHEN 5 THEN CAST(quantity AS DECIMAL(20,6))
    WHEN 6 THEN CAST(value AS DECIMAL(20,6)) END) AS DOUBLE) AS total
FROM (SELECT *, CAST(id % 8 AS INTEGER) AS variant FROM o)
WHERE variant BETWEEN 1 AND 6 GROUP BY variant""",
    "replayed_rejects": f"""{_WITH_ORDERS}
SELECT variant, CASE WHEN mends THEN 'replayed' ELSE 'left' END AS outcome, count(*) AS n,
  CASE WHEN mends THEN count(*) END AS dated,
  CASE WHEN mends THEN CAST(sum(quantity) AS BIGINT) END AS units,
  CASE WHEN mends THEN CAST(sum(total_d) AS DOUBLE) END AS revenue
FROM (SELECT *, CAST(id % 8 AS INTEGER) AS variant, id % 8 IN (2, 5, 6) AS mends FROM o)
WHERE variant BETWEEN 1 AND 6 GROUP BY variant, mends""",
    "orders_sent_again": f"""{_WITH_ORDERS}
SELECT price_tier, count(*) AS orders, CAST(sum(total_d) AS DOUBLE) AS revenue,
  CAST(0 AS BIGINT) AS lag_seconds
FROM o GROUP BY price_tier""",
    "stream_progress": f"""{_PER_PART}
SELECT batch_id, CAST(1 AS BIGINT) AS batches, orders AS rows, true AS ended, false AS failed
FROM part""",
    "kpi_totals": f"{_KPIS} SELECT * FROM kpi",
    "orders_by_category": f"""{_WITH_ORDERS}
SELECT *, CAST(row_number() OVER (ORDER BY orders DESC, category) AS INTEGER) AS rank
FROM (SELECT category, count(*) AS orders FROM o GROUP BY 1)""",
    "top_cities_by_revenue": _top_cities("city"),
    "top_of_many_cities": _top_cities("city || ' ' || CAST(id % 4 AS VARCHAR)"),
    "amounts_of_every_size": f"""{_WITH_ORDERS}
SELECT count(*) AS orders, count(*) FILTER (id % 4 = 2) AS unusable_amounts,
  CAST(sum(CASE id % 4 WHEN 0 THEN 50000000000000000 WHEN 1 THEN 0.004::DECIMAL(38,9)
    WHEN 2 THEN 0 ELSE total_d END) AS DOUBLE) AS revenue
FROM o""",
    "orders_by_device": f"""{_WITH_ORDERS}
SELECT device, count(*) AS orders FROM o GROUP BY 1""",
    "payments_by_method": f"""{_WITH_PAYMENTS}
SELECT *, CAST(row_number() OVER (ORDER BY payments DESC, payment_method) AS INTEGER) AS rank
FROM (SELECT payment_method, count(*) AS payments FROM p GROUP BY 1)""",
    "dashboard_breakdowns": _BREAKDOWNS,
    "missing_field_defaults": _breakdowns(
        "if(id % 3 = 0, 'Unknown', category)",
        "if(id % 4 = 0, 'Unknown', city)",
        "if(id % 5 = 0, 'Unknown', device)",
        "if(id % 6 = 0, 'other', payment_method)",
        "if(id % 7 = 0, 0, total_d)",
    ),
    "orders_per_cycle": f"{_HOURS} SELECT * FROM series",
    "display_kpis": f"""{_KPIS}
SELECT format('{{:,}}', total_orders) AS total_orders,
  format('{{:,}}', total_clicks) AS total_clicks,
  format('{{:,}}', total_payments) AS total_payments,
  '$' || format('{{:,.2f}}', total_revenue) AS total_revenue,
  printf('%.1f%%', payment_success_rate) AS payment_success
FROM kpi""",
    "display_top_cities": f"""{_WITH_ORDERS}
SELECT city, '$' || format('{{:,.2f}}', CAST(sum(total_d) AS DOUBLE)) AS revenue
FROM o GROUP BY city ORDER BY sum(total_d) DESC, city LIMIT 10""",
    "display_cycles": f"""{_HOURS}
SELECT strftime(cycle_start, '%Y-%m-%d') AS day, strftime(cycle_start, '%H:%M:%S') AS time,
  orders, revenue
FROM series""",
    "order_pricing": """
SELECT l_orderkey, l_linenumber, CAST(subtotal AS DOUBLE) AS subtotal,
  CAST(round(subtotal * off, 2) AS DOUBLE) AS total
FROM (
  SELECT l_orderkey, l_linenumber,
    CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS DECIMAL(10,0))
      AS DECIMAL(22,2)) AS subtotal,
    CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2)) AS off
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)""",
    "payment_pricing": f"""{_WITH_PAYMENTS}
SELECT id AS event_id, amount, failure_reason FROM p""",
    "catalog_denormalise": """
SELECT p_brand, count(*) AS events
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1""",
    "lake_pruned_read": f"""{_WITH_ORDERS}
SELECT price_tier, count(*) AS n FROM o
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
  AND hour(ts) BETWEEN 9 AND 17
GROUP BY 1""",
    "stream_ingest_orders": _TIERS,
    "stream_ingest_all": f"""
SELECT CASE WHEN event_type = 'purchase' THEN 'orders'
    WHEN event_type IN ('click', 'view') THEN 'clicks' ELSE 'payments' END AS table_name,
  strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n
FROM events WHERE {_KNOWN} GROUP BY 1, 2, 3""",
    "lake_kpi_totals": f"{_KPIS} SELECT * FROM kpi",
    "publish_then_ingest": _TIERS,
    "stream_kpi_totals": f"{_KPIS} SELECT * FROM kpi",
    "stream_breakdowns": _BREAKDOWNS,
    "stream_cycles": f"{_PER_PART} SELECT * FROM part",
    "stream_cycle_series": f"""{_PER_PART},
point(second, batch_id) AS (
  VALUES (2, 0), (12, 1), (15, NULL), (18, NULL), (21, NULL), (24, NULL), (27, NULL),
    (30, NULL), (31, 2), (33, 3), (36, NULL), (39, NULL))
SELECT CAST(make_timestamp(CAST(second * 1000000 AS BIGINT)) AS TIMESTAMP) AS cycle_at,
  coalesce(orders, 0) AS orders, coalesce(revenue, 0.0) AS revenue
FROM point LEFT JOIN part USING (batch_id)""",
    "stream_orders_per_cycle": f"""{_WITH_ORDERS}
SELECT seen.cycle_start, count(o.id) AS orders,
  coalesce(CAST(sum(o.total_d) AS DOUBLE), 0.0) AS revenue
FROM (
  SELECT DISTINCT date_trunc('hour', ts) AS cycle_start FROM events WHERE {_KNOWN}) seen
LEFT JOIN o ON date_trunc('hour', o.ts) = seen.cycle_start
GROUP BY 1""",
    "lake_settled_read": _HOURLY,
    "lake_levels": _HOURLY,
    "lake_arrivals": f"""{_WITH_ORDERS}
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM o WHERE id % 2 = 1 GROUP BY 1""",
    "stream_ingest_stamps": f"{_WITH_PAYMENTS} SELECT count(*) AS n, count(*) AS stamped FROM p",
    "stream_rejects": f"""{_WITH_ORDERS}
SELECT 'ecommerce.orders' AS topic, count(*) AS n, count(*) FILTER (id % 8 <> 4) AS with_text
FROM o WHERE id % 8 BETWEEN 1 AND 6""",
    "publish_rejects": f"""
SELECT CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'rejected' ELSE {_TOPIC} END AS topic,
  count(*) AS n
FROM events WHERE {_KNOWN} GROUP BY 1""",
}
