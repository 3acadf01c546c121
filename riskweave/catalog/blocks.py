"""SQL building blocks: the derived input tables of ``riskweave.plans.inputs`` in SQL."""

from riskweave.catalog.registry import cte

cte("fx_lines", """
SELECT l.*, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
  date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lead_days
FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
""")

cte("fx_suppliers", """
SELECT 'SUP_' || s_suppkey AS supplier_id, s_name AS supplier_name, s_name || ' Holdings' AS parent_company,
  n_name AS country, r_name AS region,
  ['anvil','bolt','gear','gizmo','plate','ring','rod','widget'][s_suppkey % 8 + 1] AS supplier_category,
  CASE WHEN s_acctbal >= 6416 THEN 'Tier 1' WHEN s_acctbal >= 2432 THEN 'Tier 2' ELSE 'Tier 3' END AS criticality_tier,
  round(s_acctbal * 1000, 2) AS annual_spend, s_suppkey % 5 = 0 AS single_source_flag,
  CAST(7 + s_suppkey % 21 AS INTEGER) AS default_lead_time_days
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

cte("fx_aliases", """
SELECT 'SUP_' || s_suppkey AS supplier_id, s_name AS alias_name, 'official' AS alias_type, 0.95::DOUBLE AS match_confidence FROM supplier
UNION ALL SELECT 'SUP_' || s_suppkey, 'SUP_' || s_suppkey, 'code', 0.9::DOUBLE FROM supplier
UNION ALL SELECT 'SUP_' || min(s_suppkey), p_name, 'trade_name', 0.8::DOUBLE FROM part JOIN supplier ON p_partkey = s_suppkey GROUP BY p_name
""")

cte("fx_pairs", """
SELECT l_suppkey, l_partkey, sum(l_quantity) AS qty, CAST(min(l_quantity) AS INTEGER) AS moq, sum(lead_days) AS lead_sum, count(*) AS n
FROM fx_lines GROUP BY ALL
""")

cte("fx_sku_map", """
SELECT 'SUP_' || l_suppkey AS supplier_id, 'SKU_' || l_partkey AS sku_id,
  qty / sum(qty) OVER (PARTITION BY l_partkey) AS dependency_percent,
  row_number() OVER (PARTITION BY l_partkey ORDER BY qty DESC, l_suppkey) = 1 AS is_primary_supplier,
  count(*) OVER (PARTITION BY l_partkey) > 1 AS alternate_supplier_available,
  greatest(1, CAST(abs(round(lead_sum / n)) AS INTEGER)) AS standard_lead_time_days,
  n_name AS origin_country, n_name || '_PORT' AS origin_port, 'DC_' || (l_partkey % 4) AS destination_dc,
  ['ocean','truck','air'][l_suppkey % 3 + 1] AS transport_mode, moq AS minimum_order_quantity,
  l_suppkey AS supplier_key, l_partkey AS part_key
FROM fx_pairs LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
""")

cte("fx_alternates", """
SELECT a.sku_id, p.supplier_id AS primary_supplier_id, a.supplier_id AS alternate_supplier_id,
  (a.supplier_key + a.part_key) % 4 <> 0 AS approved_flag,
  ['low','medium','high'][a.supplier_key % 3 + 1] AS switching_cost_level,
  CAST(5 + a.supplier_key % 30 AS INTEGER) AS estimated_switch_days,
  1 - a.dependency_percent AS capacity_available_pct
FROM fx_sku_map a JOIN fx_sku_map p ON a.sku_id = p.sku_id AND p.is_primary_supplier WHERE NOT a.is_primary_supplier
""")

cte("fx_scorecards", """
SELECT 'SUP_' || l_suppkey AS supplier_id, CAST(date_trunc('month', ship_date) AS DATE) AS scorecard_month,
  1 - count(*) FILTER (l_returnflag = 'R') / count(*) AS fill_rate,
  count(*) FILTER (lead_days <= 39) / count(*) AS on_time_delivery_rate,
  avg(l_tax) AS quality_issue_rate, avg(lead_days) AS avg_lead_time_days,
  var_pop(lead_days) AS lead_time_variance, avg(l_discount) AS defect_rate,
  1 - count(*) FILTER (l_returnflag = 'R') / count(*) < 0.6 AS is_deteriorating
FROM fx_lines GROUP BY 1, 2
""")

cte("fx_purchase_orders", """
SELECT 'PO_' || l_orderkey AS po_id, 'PO_' || l_orderkey || '_' || l_linenumber AS po_line_id,
  'SUP_' || l_suppkey AS supplier_id, 'SKU_' || l_partkey AS sku_id, order_date,
  order_date + 30 AS expected_delivery_date, ship_date AS actual_delivery_date,
  CAST(l_quantity AS INTEGER) AS quantity_ordered, CAST(floor(l_quantity * (1 - l_discount)) AS INTEGER) AS quantity_received,
  CASE o_orderstatus WHEN 'F' THEN 'received' WHEN 'O' THEN 'open' ELSE 'partial' END AS status
FROM fx_lines
""")

cte("fx_routes", """
SELECT 'RT_' || l_suppkey || '_' || l_returnflag AS route_id, 'SUP_' || l_suppkey AS supplier_id,
  n_name AS origin_country, n_name || '_PORT' AS origin_port, 'DC_' || l_returnflag AS destination_dc,
  CASE l_returnflag WHEN 'A' THEN 'ocean' WHEN 'N' THEN 'truck' ELSE 'air' END AS transport_mode,
  'CARRIER_' || (l_suppkey % 5) AS carrier, CAST(10 + l_suppkey % 20 AS INTEGER) AS standard_transit_days,
  CASE WHEN l_returnflag = 'R' THEN r_name || ' AIR' ELSE r_name END AS risk_region
FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

cte("fx_calendar", """
SELECT date, 'd_' || (date_diff('day', DATE '1995-01-01', date) + 1) AS d,
  CAST(floor(date_diff('day', DATE '1995-01-01', date) / 7) + 11101 AS INTEGER) AS wm_yr_wk,
  dayname(date) AS weekday, dayofweek(date) + 1 AS wday, month(date) AS month, year(date) AS year,
  CASE WHEN day(date) IN (1, 15) THEN 'Event' || day(date) END AS event_name_1,
  CASE WHEN day(date) IN (1, 15) THEN 'Cultural' END AS event_type_1,
  CASE WHEN day(date) = 15 AND month(date) = 12 THEN 'YearEnd' END AS event_name_2,
  CASE WHEN day(date) = 15 AND month(date) = 12 THEN 'Sporting' END AS event_type_2,
  day(date) <= 10 AS snap_ca, day(date) BETWEEN 3 AND 12 AS snap_tx, day(date) BETWEEN 6 AND 15 AS snap_wi
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)
""")

cte("fx_sales_daily", """
SELECT 'ITEM_' || l_partkey AS item_id, ['CA_1','TX_1','WI_1'][l_suppkey % 3 + 1] AS store_id,
  substr(['CA_1','TX_1','WI_1'][l_suppkey % 3 + 1], 1, 2) AS state_id, CAST(l_shipdate AS DATE) AS calendar_date,
  'd_' || (date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1) AS d,
  CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7) + 11101 AS INTEGER) AS wm_yr_wk,
  CAST(sum(l_quantity) AS BIGINT) AS units_sold, l_partkey
FROM lineitem GROUP BY ALL
""")

cte("fx_prices", """
SELECT ['CA_1','TX_1','WI_1'][l_suppkey % 3 + 1] AS store_id, 'ITEM_' || l_partkey AS item_id,
  CAST(floor(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) / 7) + 11101 AS INTEGER) AS wm_yr_wk,
  sum(l_extendedprice) / sum(l_quantity) AS sell_price
FROM lineitem GROUP BY ALL
""")

cte("fx_inventory", """
SELECT CAST(l_shipdate AS DATE) AS inventory_date, ['CA_1','TX_1','WI_1'][l_suppkey % 3 + 1] AS store_id,
  'P_' || l_partkey AS product_id, p_type AS category, p_brand AS seasonality, p_size * 10 AS inventory_level,
  CAST(sum(l_quantity) AS INTEGER) AS units_sold, CAST(round(sum(l_tax) * 100) AS INTEGER) AS units_ordered,
  CAST(sum(l_quantity) - 25 AS DOUBLE) AS demand_forecast_raw,
  sum(l_extendedprice) / sum(l_quantity) AS price, avg(l_discount) AS discount,
  sum(l_extendedprice) / sum(l_quantity) * 0.97 AS competitor_pricing,
  CAST(day(CAST(l_shipdate AS DATE)) IN (1, 15) AS INTEGER) AS holiday_promotion_flag
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY CAST(l_shipdate AS DATE), l_suppkey % 3, l_partkey, p_type, p_brand, p_size
""")

cte("fx_crosswalk", """
SELECT 'SKU_' || p_partkey AS canonical_sku_id, u.system AS source_system, u.pid AS source_product_id, p_name AS source_product_name,
  p_type AS source_category, p_brand AS source_department, u.conf AS confidence, 'native_id' AS mapping_rule
FROM (
  SELECT *, 'm5' AS system, 'ITEM_' || p_partkey AS pid, 1.0::DOUBLE AS conf FROM part
  UNION ALL SELECT *, 'retail_inventory', 'P_' || p_partkey, 0.9::DOUBLE FROM part WHERE p_partkey % 3 <> 1
  UNION ALL SELECT *, 'dataco', CAST(p_partkey AS VARCHAR), 0.8::DOUBLE FROM part WHERE p_partkey % 3 <> 2) u
""")

cte("fx_event_rows", """
SELECT e.*, k, CAST(ts AS DATE) AS event_date, event_id // 100 AS payload_no,
  CASE WHEN event_type = 'click' AND k < 90 THEN 'gdelt' WHEN event_type = 'click' THEN 'sec_edgar' WHEN event_type = 'error' THEN 'cisa'
    WHEN event_type = 'view' THEN 'nws' WHEN event_type = 'signup' THEN 'ofac' WHEN value >= 50 THEN 'cpsc' ELSE 'eia' END AS source_name,
  event_type || ' notice: ' || coalesce(p_name, 'goods') || ' from Supplier#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS title,
  'NATION_' || (user_id % 25) AS country, r_name || CASE WHEN k % 2 = 0 THEN ' COAST' ELSE '' END AS region,
  CASE WHEN value >= 200 THEN 'extreme' WHEN value >= 100 THEN 'severe' WHEN value >= 50 THEN 'moderate'
    WHEN value >= 10 THEN 'minor' WHEN value >= 5 THEN 'advisory' ELSE 'n/a' END AS sev_word
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e
LEFT JOIN part ON p_partkey = k LEFT JOIN region ON r_regionkey = k % 5
""")

cte("fx_external_events", """
SELECT sha256(source_name || '||' || event_id) AS external_event_id, event_id, source_name,
  CASE source_name WHEN 'gdelt' THEN 'news_disruption' WHEN 'nws' THEN 'weather_logistics' WHEN 'cisa' THEN 'cyber'
    WHEN 'cpsc' THEN 'quality_recall' WHEN 'ofac' THEN 'sanctions_compliance' WHEN 'sec_edgar' THEN 'financial_filing'
    ELSE 'fuel_logistics_cost' END AS risk_category,
  event_type, title AS event_title, coalesce(text, title) AS event_summary,
  CASE sev_word WHEN 'extreme' THEN 'critical' WHEN 'severe' THEN 'high' WHEN 'moderate' THEN 'medium' WHEN 'advisory' THEN 'medium'
    WHEN 'minor' THEN 'low' ELSE 'unknown' END AS severity,
  CASE sev_word WHEN 'extreme' THEN 20 WHEN 'severe' THEN 12 WHEN 'moderate' THEN 6 WHEN 'advisory' THEN 6 ELSE 2 END AS points,
  event_date, ts AS event_timestamp, 'https://example.org/e/' || event_id AS source_url, country AS event_country,
  CASE WHEN source_name IN ('nws', 'gdelt') THEN region END AS event_region,
  source_name || '_run_' || payload_no AS api_run_id
FROM fx_event_rows LEFT JOIN documents ON doc_id = event_id
""")

cte("fx_vectors", """
SELECT 'CH_' || vec_id AS chunk_id, ['risk_explanation','external_event','external_event','note'][doc_id % 4 + 1] AS chunk_type,
  CASE WHEN label < 8 THEN 'SUP_' || label END AS supplier_id,
  CASE WHEN doc_id % 3 <> 0 THEN 'SKU_' || (doc_id % 3) END AS sku_id,
  ['internal_risk_engine','gdelt','nws','cisa','blog'][n_chars % 5 + 1] AS source_name,
  ['supplier_risk','cyber','weather','logistics','misc'][doc_id % 5 + 1] AS risk_category,
  DATE '2024-01-30' - CAST(n_chars % 400 AS INTEGER) AS event_date,
  CASE WHEN n_chars >= 4000 THEN 'critical' WHEN n_chars >= 2000 THEN 'high' WHEN n_chars >= 800 THEN 'medium' ELSE 'low' END AS severity,
  text AS chunk_text, label, vec_id, embedding
FROM embeddings JOIN documents ON vec_id = doc_id
""")
