"""The registered queries once more as plain SQL, written the direct way
(row-level joins, COUNT DISTINCT, full outer joins) so they check the
DataFrame versions independently. Money is counted in whole cents."""

from __future__ import annotations

import re

from rootlens.operators.marts import CATEGORY_GROUPS, PAYMENT_NAMES, REGIONS
from rootlens.sources.star import CATEGORIES, PAYMENTS, STATES, STATUSES


def _quoted(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def _switch(column: str, names) -> str:
    return "CASE " + column + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


def _groups(column: str, groups, otherwise: str) -> str:
    whens = "".join(f" WHEN {column} IN ({_quoted(v)}) THEN '{k}'" for k, v in groups.items())
    return f"CASE{whens} ELSE '{otherwise}' END"


def sql_mean(total: str, n: str) -> str:
    """Half-up mean of whole cents."""
    return f"(2 * ({total}) + ({n})) // (2 * ({n}))"


def sql_usd(cents: str) -> str:
    return f"(CAST({cents} AS DOUBLE) / 100)"


def sql_pct(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) = 0 THEN NULL ELSE CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100 END"


def sql_pct0(part: str, whole: str) -> str:
    return f"COALESCE(round_even({sql_pct(part, whole)}, 2), 0.0)"


def sql_num(x: str, digits: int) -> str:
    fixed = f"CAST(CAST(round_even({x}, {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"
    return f"regexp_replace({fixed}, '(\\.\\d+?)0+$', '\\1')"


def sql_money(x: str) -> str:
    return f"COALESCE(format('{{:,.2f}}', CAST(abs({x}) AS DOUBLE)), '0.00')"


def sql_signed(x: str) -> str:
    return f"printf('%+.1f', round_even({x}, 1))"


def sql_title(x: str) -> str:
    """Words of letters only, separated by single blanks, hyphens or underscores."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


BRAND = "Metric Watch"
STAMP = "2024-01-01 00:00:00"
EXCLUDED = "('canceled', 'unavailable')"
PAIR = 'metric, cur::VARCHAR AS "current_date", prev::VARCHAR AS previous_date'

CTE: dict[str, str] = {}

# -- raw and staging ---------------------------------------------------------
CTE["raw_orders"] = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       {_switch('o_orderstatus', STATUSES)} AS order_status,
       o_orderdate AS bought, o_orderdate + to_hours(CAST(o_orderkey % 240 AS INTEGER)) AS delivered
FROM orders"""
CTE["stg_orders"] = """
SELECT *, CAST(bought AS DATE) AS order_date, year(bought) AS order_year, month(bought) AS order_month,
       dayofweek(bought) AS order_day_of_week, date_diff('day', bought, delivered) AS delivery_days
FROM raw_orders WHERE bought IS NOT NULL"""
CTE["raw_items"] = """
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
       l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value
FROM lineitem"""
CTE["stg_order_items"] = """
SELECT *, price + freight_value AS total_item_value,
       CAST((price + freight_value) * 100 AS BIGINT) AS cents FROM raw_items"""
CTE["stg_customers"] = f"""
SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_mktsegment AS customer_city,
       CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
       [{_quoted(STATES)}][c_nationkey + 1] AS customer_state FROM customer"""
CTE["translation"] = f"""
SELECT * FROM (SELECT DISTINCT p_brand AS product_category_name,
       [{_quoted(CATEGORIES)}][CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER)] AS english
       FROM part) WHERE english IS NOT NULL"""
CTE["stg_products"] = """
SELECT p_partkey AS product_id, p_brand AS raw_category, english,
       COALESCE(english, p_brand, 'unknown') AS product_category, p_size AS product_weight_g
FROM part LEFT JOIN translation ON p_brand = product_category_name"""
CTE["payments"] = f"""
SELECT o_orderkey AS order_id, 1 AS payment_sequential,
       {_switch('o_orderpriority', PAYMENTS)} AS payment_type FROM orders"""

# -- dimensions and marts ------------------------------------------------------
CTE["dim_geography"] = f"""
SELECT DISTINCT customer_state AS state_code, {_groups('customer_state', REGIONS, 'Unknown')} AS region
FROM stg_customers WHERE customer_state IS NOT NULL"""
CTE["dim_product"] = f"""
SELECT DISTINCT product_category, {_groups('product_category', CATEGORY_GROUPS, 'Other')} AS product_category_group
FROM stg_products WHERE product_category IS NOT NULL"""
CTE["dim_payment"] = f"""
SELECT DISTINCT payment_type, {_groups('payment_type', {v: [k] for k, v in PAYMENT_NAMES.items()}, 'Other')} AS payment_type_display
FROM payments WHERE payment_type IS NOT NULL"""
CTE["counted_lines"] = f"""
SELECT o.order_id, o.order_date, o.customer_id, o.order_status, i.order_item_id, i.product_id, i.cents
FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id WHERE o.order_status NOT IN {EXCLUDED}"""
CTE["order_revenue"] = """
SELECT order_id, order_date, customer_id, order_status, SUM(cents) AS cents
FROM counted_lines GROUP BY ALL"""
CTE["fact"] = f"""
SELECT order_date AS metric_date, COUNT(DISTINCT order_id) AS order_count,
       COUNT(DISTINCT customer_id) AS customer_count, SUM(cents) AS revenue_c,
       {sql_mean('SUM(cents)', 'COUNT(*)')} AS avg_c, MIN(cents) AS min_c, MAX(cents) AS max_c
FROM order_revenue GROUP BY order_date"""
CTE["by_geography"] = f"""
SELECT l.order_date AS metric_date, c.customer_state AS state_code, g.region,
       COUNT(DISTINCT l.order_id) AS order_count, SUM(l.cents) AS revenue_c, {sql_mean('SUM(l.cents)', 'COUNT(*)')} AS avg_c
FROM counted_lines l JOIN stg_customers c ON l.customer_id = c.customer_id
JOIN dim_geography g ON c.customer_state = g.state_code GROUP BY ALL"""
CTE["by_product"] = f"""
SELECT l.order_date AS metric_date, p.product_category, g.product_category_group,
       COUNT(DISTINCT l.order_id) AS order_count, SUM(l.cents) AS revenue_c, {sql_mean('SUM(l.cents)', 'COUNT(*)')} AS avg_c
FROM counted_lines l JOIN stg_products p ON l.product_id = p.product_id
JOIN dim_product g ON p.product_category = g.product_category GROUP BY ALL"""
CTE["payment_orders"] = f"""
SELECT o.order_id, o.order_date, p.payment_type, d.payment_type_display, r.cents
FROM stg_orders o JOIN (SELECT order_id, SUM(cents) AS cents FROM stg_order_items GROUP BY order_id) r USING (order_id)
JOIN (SELECT * FROM payments WHERE payment_sequential = 1) p USING (order_id)
JOIN dim_payment d ON p.payment_type = d.payment_type WHERE o.order_status NOT IN {EXCLUDED}"""
CTE["by_payment"] = f"""
SELECT order_date AS metric_date, payment_type, payment_type_display,
       COUNT(DISTINCT order_id) AS order_count, SUM(cents) AS revenue_c, {sql_mean('SUM(cents)', 'COUNT(*)')} AS avg_c
FROM payment_orders GROUP BY ALL"""

# -- detection ------------------------------------------------------------------
CTE["metrics_long"] = """
SELECT metric_date, 'order_count' AS metric, CAST(order_count AS DOUBLE) AS value FROM fact
UNION ALL SELECT metric_date, 'customer_count', CAST(customer_count AS DOUBLE) FROM fact
UNION ALL SELECT metric_date, 'total_revenue', CAST(revenue_c AS DOUBLE) / 100 FROM fact
UNION ALL SELECT metric_date, 'avg_order_value', CAST(avg_c AS DOUBLE) / 100 FROM fact"""
CTE["last_30"] = """
SELECT * FROM metrics_long WHERE metric_date IN (SELECT metric_date FROM fact ORDER BY metric_date DESC LIMIT 30)"""


def _scored(source: str) -> str:
    return f"""
SELECT *, COALESCE(abs(z) > 2.0, FALSE) AS is_anomaly,
       CASE WHEN z > 2.0 THEN 'high' WHEN z < -2.0 THEN 'low' ELSE 'normal' END AS direction,
       value - prev_value AS change_value, round_even({sql_pct('value - prev_value', 'prev_value')}, 2) AS change_pct
FROM (SELECT *, (value - avg(value) OVER m) / NULLIF(stddev_samp(value) OVER m, 0) AS z,
             lag(value) OVER (PARTITION BY metric ORDER BY metric_date) AS prev_value
      FROM {source} WINDOW m AS (PARTITION BY metric))"""


CTE["scored"] = _scored("metrics_long")
CTE["scored_30"] = _scored("last_30")
CTE["stats_30"] = """
SELECT metric, COUNT(*) AS days, COUNT(*) FILTER (is_anomaly) AS anomaly_count, round_even(avg(value), 2) AS mean,
       round_even(stddev_samp(value), 2) AS std, round_even(min(value), 2) AS min, round_even(max(value), 2) AS max
FROM scored_30 GROUP BY metric"""

CTE["numbered_days"] = "SELECT *, row_number() OVER (PARTITION BY metric ORDER BY metric_date) AS n FROM metrics_long"
CTE["windows_30"] = """
SELECT a.metric, a.metric_date, a.value, a.n, avg(b.value) AS mean, stddev_samp(b.value) AS std, COUNT(*) AS days,
       min(b.value) AS least_value, max(b.value) AS most_value
FROM numbered_days a JOIN numbered_days b ON b.metric = a.metric AND b.n BETWEEN a.n - 29 AND a.n GROUP BY ALL"""

# -- decomposition ----------------------------------------------------------------
CTE["pairs"] = """
SELECT * FROM (SELECT metric_date AS cur, lag(metric_date) OVER (ORDER BY metric_date) AS prev
               FROM (SELECT DISTINCT metric_date FROM fact)) WHERE prev IS NOT NULL"""
CTE["last_pair"] = "SELECT * FROM pairs ORDER BY cur DESC LIMIT 1"
CTE["slices"] = """
SELECT metric_date, 'geography' AS dimension, 0 AS dim_order, region AS segment, state_code AS detail, 'total_revenue' AS metric, revenue_c AS c FROM by_geography
UNION ALL SELECT metric_date, 'geography', 0, region, state_code, 'order_count', order_count * 100 FROM by_geography
UNION ALL SELECT metric_date, 'product', 1, product_category_group, product_category, 'total_revenue', revenue_c FROM by_product
UNION ALL SELECT metric_date, 'product', 1, product_category_group, product_category, 'order_count', order_count * 100 FROM by_product
UNION ALL SELECT metric_date, 'payment', 2, payment_type_display, payment_type, 'total_revenue', revenue_c FROM by_payment
UNION ALL SELECT metric_date, 'payment', 2, payment_type_display, payment_type, 'order_count', order_count * 100 FROM by_payment
UNION ALL SELECT metric_date, 'payment', 2, payment_type_display, payment_type, 'avg_order_value', avg_c FROM by_payment"""
CTE["sides"] = """
SELECT cur, prev, metric, dimension, dim_order, segment, SUM(c) AS c, 1 AS side
FROM slices JOIN pairs ON metric_date = cur GROUP BY ALL
UNION ALL
SELECT cur, prev, metric, dimension, dim_order, segment, SUM(c), 0
FROM slices JOIN pairs ON metric_date = prev GROUP BY ALL"""
CTE["compared"] = f"""
SELECT cur, prev, metric, dimension, dim_order, segment,
       {sql_usd('COALESCE(a.c, 0)')} AS current_value, {sql_usd('COALESCE(b.c, 0)')} AS previous_value,
       {sql_usd('COALESCE(a.c, 0) - COALESCE(b.c, 0)')} AS change, COALESCE(a.c, 0) AS cur_c, COALESCE(b.c, 0) AS prev_c
FROM (SELECT * FROM sides WHERE side = 1) a FULL JOIN (SELECT * FROM sides WHERE side = 0) b
USING (cur, prev, metric, dimension, dim_order, segment)"""
CTE["contributed"] = f"""
SELECT *, abs(contribution_pct) AS abs_contribution FROM (
  SELECT *, {sql_pct0('change', 'previous_value')} AS change_pct, {sql_pct0('change', 'total')} AS contribution_pct
  FROM (SELECT *, {sql_usd('SUM(cur_c - prev_c) OVER (PARTITION BY cur, prev, metric, dimension)')} AS total FROM compared))"""
CTE["top"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cur, prev, metric, dimension
               ORDER BY abs_contribution DESC, current_value DESC, segment) AS rank FROM contributed) WHERE rank <= 5"""
CTE["totals"] = f"""
SELECT cur, prev, metric, dimension, dim_order, {sql_usd('SUM(cur_c)')} AS total_current, {sql_usd('SUM(prev_c)')} AS total_previous,
       {sql_usd('SUM(cur_c) - SUM(prev_c)')} AS total_change,
       {sql_pct0(sql_usd('SUM(cur_c) - SUM(prev_c)'), sql_usd('SUM(prev_c)'))} AS total_change_pct, COUNT(*) AS segment_count
FROM compared GROUP BY ALL"""
CTE["drivers"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cur, prev, metric
               ORDER BY abs_contribution DESC, dim_order, rank) AS pick FROM top WHERE abs_contribution > 0) WHERE pick = 1"""
CTE["classified"] = """
SELECT cur, prev, metric, dimension, dim_order, segment, lead, gap,
       CASE WHEN lead < 0 OR lead > 100 THEN 'offsetting_segments' WHEN gap <= 15 THEN 'close_contributors' END AS reason
FROM (SELECT *, contribution_pct AS lead,
             abs(abs_contribution - lead(abs_contribution) OVER (PARTITION BY cur, prev, metric, dimension ORDER BY rank)) AS gap
      FROM top) WHERE rank = 1"""
CTE["targets"] = "SELECT cur, prev, metric, dimension, dim_order, segment FROM classified WHERE reason = 'close_contributors'"
CTE["drill_sides"] = """
SELECT t.cur, t.prev, t.metric, t.dimension, t.dim_order, t.segment AS parent, s.detail AS segment, SUM(s.c) AS c, 1 AS side
FROM targets t JOIN slices s ON s.metric_date = t.cur AND s.metric = t.metric AND s.dimension = t.dimension AND s.segment = t.segment GROUP BY ALL
UNION ALL
SELECT t.cur, t.prev, t.metric, t.dimension, t.dim_order, t.segment, s.detail, SUM(s.c), 0
FROM targets t JOIN slices s ON s.metric_date = t.prev AND s.metric = t.metric AND s.dimension = t.dimension AND s.segment = t.segment GROUP BY ALL"""
CTE["drilled"] = f"""
SELECT *, abs(contribution_pct) AS abs_contribution FROM (
  SELECT *, {sql_pct0('change', 'previous_value')} AS change_pct, {sql_pct0('change', 'total')} AS contribution_pct FROM (
    SELECT *, {sql_usd('SUM(cur_c - prev_c) OVER (PARTITION BY cur, prev, metric, dimension, parent)')} AS total FROM (
      SELECT cur, prev, metric, dimension, dim_order, parent, segment, COALESCE(a.c, 0) AS cur_c, COALESCE(b.c, 0) AS prev_c,
             {sql_usd('COALESCE(a.c, 0)')} AS current_value, {sql_usd('COALESCE(b.c, 0)')} AS previous_value,
             {sql_usd('COALESCE(a.c, 0) - COALESCE(b.c, 0)')} AS change
      FROM (SELECT * FROM drill_sides WHERE side = 1) a FULL JOIN (SELECT * FROM drill_sides WHERE side = 0) b
      USING (cur, prev, metric, dimension, dim_order, parent, segment))))"""
CTE["drill_top"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cur, prev, metric, dimension, parent
               ORDER BY abs_contribution DESC, current_value DESC, segment) AS rank FROM drilled) WHERE rank <= 5"""
CTE["evidence"] = """
SELECT cur, prev, metric, 'decomposition' AS source, dimension, dim_order, segment, rank, current_value, previous_value, change, change_pct, contribution_pct FROM top
UNION ALL SELECT cur, prev, metric, 'drill_down', dimension, dim_order, segment, rank, current_value, previous_value, change, change_pct, contribution_pct FROM drill_top"""

# -- texts ------------------------------------------------------------------------
_SHARE1 = sql_num("contribution_pct", 1)
CTE["texts"] = f"""
SELECT cur, prev, metric,
  '📊 **{BRAND} Alert: ' || name || ' ' || word || '**' || chr(10) || chr(10) || '**' || cur::VARCHAR || '** vs **' || prev::VARCHAR || '**'
  || chr(10) || chr(10) || name || ' ' || word || 'd **' || pct || '%** ($' || {sql_money('total_previous')} || ' → $' || {sql_money('total_current')}
  || '), a change of **$' || {sql_money('total_change')} || '**.' || chr(10) || chr(10) || '**Primary Driver:**' || chr(10)
  || CASE WHEN d_segment IS NULL THEN 'No single driver stands out.' ELSE 'The ' || word || ' was primarily driven by **' || {sql_title('d_dimension')}
     || '** — specifically **' || d_segment || '**, which accounted for **' || {sql_num('abs(d_pct)', 2)} || '%** of the total change.' END
  || chr(10) || chr(10) || '**Breakdown by Dimension:**' || chr(10) || full_lines || chr(10) || chr(10) || '---' || chr(10)
  || '*Generated by {BRAND} at {STAMP}*' AS "full",
  ':chart_with_' || CASE WHEN word = 'increase' THEN 'upwards' ELSE 'downwards' END || '_trend: *{BRAND} Alert*' || chr(10) || chr(10)
  || '*' || name || '* ' || word || 'd *' || pct || '%* on ' || cur::VARCHAR || chr(10) || chr(10) || ':mag: *Root Cause:* '
  || CASE WHEN d_segment IS NULL THEN 'No single driver stands out.' ELSE d_segment || ' (' || d_dimension || ') drove ' || {sql_num('abs(d_pct)', 2)} || '% of the change' END
  || chr(10) || chr(10) || ':bar_chart: Breakdown:' || chr(10) || slack_lines AS slack,
  '{BRAND}: ' || name || ' ' || word || ' ' || pct || '% on ' || cur::VARCHAR AS email_subject,
  name || ' ' || word || 'd ' || pct || '% on ' || cur::VARCHAR || '. ' || CASE WHEN d_segment IS NULL THEN 'No single driver stands out.'
     ELSE 'Primary driver: ' || d_segment || ' (' || d_dimension || ') contributed ' || {sql_num('abs(round_even(d_pct, 1))', 1)} || '% of the change.' END AS summary
FROM (SELECT h.*, {sql_title("replace(h.metric, '_', ' ')")} AS name, CASE WHEN total_change > 0 THEN 'increase' ELSE 'decrease' END AS word,
             {sql_num('abs(round_even(total_change_pct, 1))', 1)} AS pct, d.segment AS d_segment, d.dimension AS d_dimension, d.contribution_pct AS d_pct,
             l.full_lines, l.slack_lines
      FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cur, prev, metric ORDER BY dim_order) AS n FROM totals) WHERE n = 1) h
      JOIN (SELECT cur, prev, metric,
              string_agg(chr(10) || '- **' || {sql_title('dimension')} || '**: Top contributor was **' || segment || '** (' || {_SHARE1} || '% of change)' || chr(10), '' ORDER BY dim_order) AS full_lines,
              string_agg('• ' || {sql_title('dimension')} || ': ' || segment || ' (' || {_SHARE1} || '%)', chr(10) ORDER BY dim_order) AS slack_lines
            FROM top WHERE rank = 1 GROUP BY ALL) l USING (cur, prev, metric)
      LEFT JOIN drivers d USING (cur, prev, metric))"""
CTE["fallback"] = f"""
SELECT cur, prev, metric, 'The primary driver was ' || segment || ' (' || dimension || '), contributing '
       || {sql_num('abs(round_even(contribution_pct, 1))', 1)} || '% of the change (' || {sql_signed('change_pct')} || '% change).' AS investigation_summary
FROM drivers"""
# A statement repeats what led the pair before: right for some pairs, stale for others.
CTE["citations"] = """
SELECT t.metric, p.cur, p.prev, t.dim_order AS position, t.dimension, t.segment, 'decomposition' AS source, 'LED the change' AS claim
FROM top t JOIN pairs p ON p.prev = t.cur WHERE t.rank = 1 AND t.metric = 'total_revenue'"""
CTE["notes"] = """
SELECT DISTINCT metric, cur, prev, CASE WHEN day(cur) % 2 = 0 THEN 'segments moved in opposite directions' END AS note FROM citations"""
CTE["invalid"] = """
SELECT c.* FROM citations c ANTI JOIN evidence e ON c.metric = e.metric AND c.cur = e.cur AND c.prev = e.prev
AND c.source = e.source AND c.dimension = e.dimension AND c.segment = e.segment"""
CTE["errors"] = """
SELECT i.metric, i.cur, i.prev, i.position, '''' || i.segment || ''' is not a valid segment for ''' || i.dimension || ''' (source=' || i.source
       || '); valid segments are: ' || COALESCE(k.valid, '(none)') AS error
FROM invalid i LEFT JOIN (SELECT metric, cur, prev, source, dimension, string_agg(DISTINCT segment, ', ' ORDER BY segment) AS valid
                          FROM evidence GROUP BY ALL) k USING (metric, cur, prev, source, dimension)
UNION ALL
SELECT n.metric, n.cur, n.prev, NULL, 'uncertainty_note is required because an offsetting_segments dimension is present in the evidence, but it was null'
FROM notes n WHERE n.note IS NULL AND EXISTS (SELECT 1 FROM classified c WHERE c.metric = n.metric AND c.cur = n.cur
     AND c.prev = n.prev AND c.reason = 'offsetting_segments')"""
# Statements that cite a pair's own leaders.
CTE["own_citations"] = """
SELECT metric, cur, prev, dim_order AS position, dimension, segment, 'LED the change' AS claim, contribution_pct, current_value, previous_value
FROM top WHERE rank = 1 AND metric = 'total_revenue'"""
CTE["rendered"] = f"""
SELECT metric, cur, prev,
  max(CASE WHEN position = 0 THEN 'Led the change: **' || segment || '** (' || {sql_title('dimension')} || ') contributed **' || {sql_num('abs(contribution_pct)', 2)}
      || '%** of the change ($' || {sql_money('previous_value')} || ' -> $' || {sql_money('current_value')} || ').' END)
  || CASE WHEN COUNT(*) FILTER (position > 0) > 0 THEN chr(10) || chr(10) || 'Contributing factors:' || chr(10)
      || string_agg('- ' || claim || ': ' || segment || ' (' || {sql_num('abs(contribution_pct)', 2)} || '%)', chr(10) ORDER BY position) FILTER (position > 0) ELSE '' END
  || CASE WHEN day(cur) % 2 = 0 THEN CASE WHEN COUNT(*) FILTER (position > 0) > 0 THEN repeat(chr(10), 4) ELSE repeat(chr(10), 3) END
      || 'warning: segments moved in opposite directions' ELSE '' END AS investigation_summary
FROM own_citations GROUP BY metric, cur, prev"""

# -- onboarding of the events table ------------------------------------------------
CTE["ev"] = """
SELECT *, CAST(ts AS DATE) AS metric_date, CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) AS value_c FROM events"""
CTE["ev_fact"] = """
SELECT metric_date, SUM(value_c) AS value_c, COUNT(*) AS row_count FROM ev WHERE metric_date IS NOT NULL GROUP BY metric_date"""
CTE["ev_rollup"] = """
SELECT metric_date, 'event_type' AS dimension, 0 AS dim_order, event_type AS segment, SUM(value_c) AS value_c, COUNT(*) AS row_count
FROM ev WHERE event_type IS NOT NULL GROUP BY ALL
UNION ALL SELECT metric_date, 'props', 1, props, SUM(value_c), COUNT(*) FROM ev WHERE props IS NOT NULL GROUP BY ALL"""


def _profile(table: str, columns: list[tuple[str, str, bool, bool]]) -> str:
    """columns: (name, dtype, numeric, float); timestamps parse, texts here never do."""
    parts = []
    for position, (name, dtype, numeric, is_float) in enumerate(columns):
        temporal = dtype.startswith("timestamp")
        days = f"COUNT(DISTINCT CAST({name} AS DATE))" if temporal else "0"
        rate = "1.0" if temporal else "0.0"
        parts.append(
            f"SELECT {position} AS position, '{name}' AS name, '{dtype}' AS dtype, COUNT(*) AS n_rows, "
            f"COUNT(DISTINCT {name}) AS cardinality, COUNT({name}) AS filled, {days} AS day_cardinality, "
            f"CASE WHEN COUNT({name}) > 0 THEN {rate} ELSE 0.0 END AS date_parse_rate, "
            f"{numeric} AS is_numeric, {is_float} AS is_float FROM {table}"
        )
    return (
        "SELECT position, name, dtype, n_rows, cardinality, CAST(cardinality AS DOUBLE) / n_rows AS cardinality_ratio, "
        "1.0 - CAST(filled AS DOUBLE) / n_rows AS null_rate, CAST(date_parse_rate AS DOUBLE) AS date_parse_rate, day_cardinality, is_numeric, "
        "(CAST(cardinality AS DOUBLE) / n_rows > 0.9 AND NOT is_float) AS is_likely_id FROM ("
        + " UNION ALL ".join(parts)
        + ")"
    )


EVENT_COLUMNS = [
    ("event_id", "bigint", True, False),
    ("ts", "timestamp_ntz", False, False),
    ("user_id", "bigint", True, False),
    ("event_type", "string", False, False),
    ("value", "double", True, True),
    ("props", "string", False, False),
]
ORDER_COLUMNS = [
    ("o_orderkey", "bigint", True, False),
    ("o_custkey", "bigint", True, False),
    ("o_orderstatus", "string", False, False),
    ("o_totalprice", "double", True, True),
    ("o_orderdate", "timestamp_ntz", False, False),
    ("o_orderpriority", "string", False, False),
]
CTE["ev_profile"] = _profile("events", EVENT_COLUMNS)
CTE["order_profile"] = _profile("orders", ORDER_COLUMNS)


def _roles(profile: str) -> str:
    return f"""
SELECT position, name AS "column", role, cardinality, confidence,
       CASE WHEN role = 'date' THEN 'best date parse rate' WHEN date_like THEN 'another column is the date'
            WHEN is_likely_id THEN 'identifier' WHEN role = 'metric' THEN 'numeric and not an identifier'
            WHEN null_rate > 0.3 THEN 'too many nulls' WHEN role = 'rejected' THEN 'too many values' ELSE 'few distinct values' END AS reason
FROM (SELECT *, round_even(1.0 - null_rate, 4) AS confidence,
        CASE WHEN date_like AND choice = 1 THEN 'date' WHEN date_like OR is_likely_id THEN 'rejected' WHEN is_numeric THEN 'metric'
             WHEN null_rate > 0.3 OR cardinality_ratio > 0.1 THEN 'rejected' ELSE 'dimension' END AS role
      FROM (SELECT *, row_number() OVER (PARTITION BY date_like ORDER BY date_parse_rate DESC, null_rate, position) AS choice
            FROM (SELECT *, (NOT is_numeric AND date_parse_rate >= 0.95) AS date_like FROM {profile})))"""


CTE["ev_roles"] = _roles("ev_profile")
CTE["order_roles"] = _roles("order_profile")
CTE["ev_pairs"] = """
SELECT * FROM (SELECT metric_date AS cur, lag(metric_date) OVER (ORDER BY metric_date) AS prev FROM ev_fact) WHERE prev IS NOT NULL"""


def sql(final: str) -> str:
    """``final`` with the CTEs it needs, in definition order; complete statements pass."""
    if final.lstrip().startswith("WITH"):
        return final.strip()
    names = list(CTE)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[A-Za-z_0-9]+", text)):
            if word in CTE and word not in needed:
                needed.add(word)
                visit(CTE[word])

    visit(final)
    # materialized: several are read from many places, and must be computed once
    parts = [f"{n} AS MATERIALIZED ({CTE[n].strip()})" for n in names if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()
