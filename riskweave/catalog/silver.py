"""Typed tables, parsed events, crosswalk, domain views and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog.registry import cte, query
from riskweave.catalog.shape import tidy
from riskweave.operators import relational as R
from riskweave.plans import crosswalk as X
from riskweave.plans import events as E
from riskweave.plans import inputs as I
from riskweave.plans import marts, silver
from riskweave.session import cut_lineage
from riskweave.sources import landing as L

# ---- typed tables -----------------------------------------------------------------------------

cte("dm_calendar", """
SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS calendar_date_id, date AS calendar_date, d AS day_id, wm_yr_wk AS wm_year_week, weekday AS weekday_name,
  wday AS weekday_number, year AS calendar_year, quarter(date) AS calendar_quarter, month AS month_number, day(date) AS day_of_month, week(date) AS week_of_year,
  dayofweek(date) IN (0, 6) AS is_weekend, event_name_1 IS NOT NULL OR event_name_2 IS NOT NULL AS is_event_day,
  CAST(event_name_1 IS NOT NULL AS INT) + CAST(event_name_2 IS NOT NULL AS INT) AS event_count, event_name_1, event_type_1, event_name_2, event_type_2,
  snap_ca, snap_tx, snap_wi, snap_ca OR snap_tx OR snap_wi AS is_snap_any_state
FROM fx_calendar
""")


@query("calendar_dimension", "P11 M08", "SELECT * REPLACE (strftime(calendar_date, '%Y-%m-%d') AS calendar_date) FROM dm_calendar")
def _(t):
    return tidy(silver.build_calendar(I.calendar(t)))


@query("price_table", "P12", """
SELECT store_id, split_part(store_id, '_', 1) AS state_id, CAST(split_part(store_id, '_', 2) AS BIGINT) AS store_number, item_id, CAST(wm_yr_wk AS BIGINT) AS wm_year_week,
  rnd(sell_price, 4) AS sell_price, sell_price > 0 AS is_valid_price, sha256(store_id || '||' || item_id || '||' || wm_yr_wk) AS price_record_id FROM fx_prices
""")
def _(t):
    return tidy(silver.build_prices(I.prices(t)))


@query("unpivot_months", "P13", """
SELECT 'ITEM_' || l_partkey || '_' || store AS id, 'm_' || m AS month_column, CAST(sum(CASE WHEN month(l_shipdate) = m THEN l_quantity ELSE 0 END) AS BIGINT) AS units
FROM (SELECT *, ['CA_1','TX_1','WI_1'][l_suppkey % 3 + 1] AS store FROM lineitem), generate_series(1, 12) AS g(m) GROUP BY 1, 2
""")
def _(t):
    return silver.unpivot_numbered(I.sales_wide(t), ["id"], "m_", "month_column", "units")


cte("dm_inventory", """
SELECT *, greatest(demand_forecast_raw, 0) AS demand_forecast, demand_forecast_raw < 0 AS demand_forecast_was_negative, inventory_level + units_ordered AS inventory_position,
  greatest(greatest(demand_forecast_raw, 0) - (inventory_level + units_ordered), 0) AS stockout_gap_units,
  greatest(demand_forecast_raw, 0) - (inventory_level + units_ordered) > 0 AS is_stockout_risk,
  CASE WHEN demand_forecast_raw > 0 THEN (inventory_level + units_ordered) / demand_forecast_raw END AS inventory_coverage_ratio,
  CASE WHEN inventory_level > 0 THEN units_sold / inventory_level END AS sell_through_rate, price - competitor_pricing AS price_vs_competitor
FROM fx_inventory
""")


@query("inventory_table", "P14", """
SELECT strftime(inventory_date, '%Y-%m-%d') AS inventory_date, store_id, product_id, CAST(inventory_level AS BIGINT) AS inventory_level, CAST(units_sold AS BIGINT) AS units_sold,
  CAST(units_ordered AS BIGINT) AS units_ordered, rnd(demand_forecast, 4) AS demand_forecast, demand_forecast_was_negative, CAST(inventory_position AS BIGINT) AS inventory_position,
  rnd(stockout_gap_units, 4) AS stockout_gap_units, is_stockout_risk, rnd(inventory_coverage_ratio, 4) AS inventory_coverage_ratio, rnd(sell_through_rate, 4) AS sell_through_rate,
  rnd(price_vs_competitor, 4) AS price_vs_competitor FROM dm_inventory
""")
def _(t):
    return tidy(
        silver.build_inventory(I.inventory(t)).select(
            "inventory_date", "store_id", "product_id", "inventory_level", "units_sold", "units_ordered", "demand_forecast", "demand_forecast_was_negative",
            "inventory_position", "stockout_gap_units", "is_stockout_risk", "inventory_coverage_ratio", "sell_through_rate", "price_vs_competitor",
        )
    )


@query("orders_table", "P15 M11", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, strftime(order_date, '%Y-%m-%d') AS order_date, strftime(ship_date, '%Y-%m-%d') AS shipping_date,
  CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS order_date_id, CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
  lead_days - 30 AS shipping_delay_days, lead_days > 30 AS is_late_delivery, lead_days > 30 AS is_delayed_beyond_schedule,
  CASE WHEN l_returnflag = 'R' THEN 'SUSPECTED_FRAUD' WHEN o_orderstatus = 'P' THEN 'CANCELED' ELSE 'COMPLETE' END AS order_status,
  l_returnflag = 'R' OR o_orderstatus = 'P' AS is_suspect_order, rnd(rnd(l_extendedprice * (l_tax - l_discount), 2) / l_extendedprice, 3) AS profit_margin
FROM fx_lines JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    return tidy(
        silver.build_orders(I.raw_orders(t)).select(
            "order_id", "order_item_id", "order_date", "shipping_date", "order_date_id", "order_year", "order_month", "shipping_delay_days", "is_late_delivery",
            "is_delayed_beyond_schedule", "order_status", "is_suspect_order", "profit_margin",
        ),
        3,
    )


cte("dm_pos", """
SELECT *, date_diff('day', order_date, expected_delivery_date) AS planned_lead_time_days, date_diff('day', order_date, actual_delivery_date) AS actual_lead_time_days,
  date_diff('day', expected_delivery_date, actual_delivery_date) AS delivery_delay_days, actual_delivery_date > expected_delivery_date AS is_po_late,
  CASE WHEN quantity_ordered > 0 THEN quantity_received / quantity_ordered END AS po_fill_rate FROM fx_purchase_orders
""")


@query("purchase_order_table", "P16", """
SELECT po_line_id, supplier_id, sku_id, planned_lead_time_days, actual_lead_time_days, delivery_delay_days, is_po_late, rnd(po_fill_rate, 4) AS po_fill_rate, sha256(po_id || '||' || po_line_id) AS po_record_id FROM dm_pos
""")
def _(t):
    return tidy(
        silver.build_purchase_orders(I.purchase_orders(t)).select(
            "po_line_id", "supplier_id", "sku_id", "planned_lead_time_days", "actual_lead_time_days", "delivery_delay_days", "is_po_late", "po_fill_rate", "po_record_id"
        )
    )


@query("typed_suppliers", "P17", """
SELECT * REPLACE (rnd(annual_spend, 2) AS annual_spend, CAST(default_lead_time_days AS BIGINT) AS default_lead_time_days), sha256(supplier_id) AS record_id FROM fx_suppliers
""")
def _(t):
    return tidy(silver.typed_table(I.suppliers(t), "suppliers"), 2)


@query("typed_aliases", "P17", "SELECT *, sha256(supplier_id || '||' || alias_name) AS record_id FROM fx_aliases")
def _(t):
    return tidy(silver.typed_table(I.aliases(t), "aliases"))


@query("typed_sku_map", "P17", """
SELECT supplier_id, sku_id, rnd(dependency_percent, 4) AS dependency_percent, is_primary_supplier, alternate_supplier_available, CAST(standard_lead_time_days AS BIGINT) AS standard_lead_time_days,
  origin_country, origin_port, destination_dc, transport_mode, CAST(minimum_order_quantity AS BIGINT) AS minimum_order_quantity, sha256(supplier_id || '||' || sku_id) AS record_id FROM fx_sku_map
""")
def _(t):
    return tidy(silver.typed_table(I.sku_map(t), "sku_map"))


@query("typed_alternates", "P17", """
SELECT sku_id, primary_supplier_id, alternate_supplier_id, approved_flag, switching_cost_level, CAST(estimated_switch_days AS BIGINT) AS estimated_switch_days,
  rnd(capacity_available_pct, 4) AS capacity_available_pct, sha256(sku_id || '||' || primary_supplier_id || '||' || alternate_supplier_id) AS record_id FROM fx_alternates
""")
def _(t):
    return tidy(silver.typed_table(I.alternates(I.sku_map(t)), "alternates"))


@query("typed_routes", "P17", "SELECT * REPLACE (CAST(standard_transit_days AS BIGINT) AS standard_transit_days), sha256(route_id || '||' || supplier_id) AS record_id FROM fx_routes")
def _(t):
    return tidy(silver.typed_table(I.routes(t), "routes"))


@query("typed_crosswalk", "P17", "SELECT *, sha256(canonical_sku_id || '||' || source_system || '||' || source_product_id) AS record_id FROM fx_crosswalk")
def _(t):
    return tidy(silver.typed_table(I.crosswalk(t), "crosswalk"))


@query("typed_scorecards", "P17", """
SELECT supplier_id, strftime(scorecard_month, '%Y-%m-%d') AS scorecard_month, rnd(fill_rate, 4) AS fill_rate, rnd(on_time_delivery_rate, 4) AS on_time_delivery_rate,
  rnd(quality_issue_rate, 4) AS quality_issue_rate, rnd(avg_lead_time_days, 4) AS avg_lead_time_days, rnd(defect_rate, 4) AS defect_rate, is_deteriorating,
  sha256(supplier_id || '||' || strftime(scorecard_month, '%Y-%m-%d')) AS record_id FROM fx_scorecards
""")
def _(t):
    return tidy(silver.build_scorecards(I.scorecards(t)).drop("lead_time_variance"))


# ---- events -----------------------------------------------------------------------------------

cte("dm_ok_items", """
SELECT * FROM fx_event_rows WHERE NOT ((payload_no // 10) % 2 = 1 AND source_name = 'nws')
""")


def _raw(t):
    return L.land_raw(I.payloads(t))


@query("parse_events", "M01", """
SELECT source_name, CASE source_name WHEN 'gdelt' THEN 'news_disruption' WHEN 'nws' THEN 'weather_logistics' WHEN 'cisa' THEN 'cyber' ELSE 'quality_recall' END AS risk_category,
  CASE source_name WHEN 'gdelt' THEN 'supply_chain_news' WHEN 'nws' THEN event_type WHEN 'cisa' THEN 'known_exploited_vulnerability' ELSE 'product_recall' END AS event_type,
  strftime(event_date, '%Y-%m-%d') AS event_date, CASE WHEN source_name = 'cisa' THEN 'CVE-' || event_id || ' - ' || title ELSE title END AS event_title,
  CASE WHEN source_name = 'gdelt' THEN country ELSE 'US' END AS event_country, CASE WHEN source_name = 'nws' THEN region END AS event_region,
  CASE source_name WHEN 'nws' THEN CASE WHEN sev_word = 'moderate' THEN ' moderate' ELSE sev_word END WHEN 'cisa' THEN CASE WHEN value >= 50 THEN 'high' ELSE 'medium' END ELSE 'medium' END AS severity,
  source_name || '_run_' || payload_no AS api_run_id
FROM dm_ok_items WHERE source_name IN ('gdelt', 'nws', 'cisa', 'cpsc')
""")
def _(t):
    return tidy(
        E.parse_events(_raw(t)).select("source_name", "risk_category", "event_type", "event_date", "event_title", "event_country", "event_region", "severity", "api_run_id")
    )


@query("snapshot_events", "M02", """
SELECT source_name, CASE source_name WHEN 'ofac' THEN 'ofac_feed' WHEN 'eia' THEN 'fuel_price_snapshot' ELSE 'company_filings_snapshot' END AS event_type,
  strftime(fetched, '%Y-%m-%d') AS event_date, CASE source_name WHEN 'ofac' THEN 'OFAC sanctions file snapshot: ofac_feed' WHEN 'eia' THEN 'EIA fuel price data snapshot' ELSE 'SEC company submissions snapshot: sec_edgar_feed' END AS event_title,
  CASE source_name WHEN 'ofac' THEN 'high' ELSE 'medium' END AS severity, api_run_id
FROM fx_payload_runs WHERE source_name IN ('ofac', 'eia', 'sec_edgar')
""")
def _(t):
    return tidy(E.snapshot_events(_raw(t)).select("source_name", "event_type", "event_date", "event_title", "severity", "api_run_id"))


cte("dm_normal_events", """
SELECT source_name, strftime(event_date, '%Y-%m-%d') AS event_date, CASE WHEN source_name = 'cisa' THEN 'CVE-' || event_id || ' - ' || title ELSE title END AS event_title,
  CASE source_name WHEN 'nws' THEN CASE WHEN sev_word = 'advisory' THEN 'medium' WHEN sev_word = 'n/a' THEN 'unknown' ELSE sev_word END WHEN 'cisa' THEN CASE WHEN value >= 50 THEN 'high' ELSE 'medium' END ELSE 'medium' END AS severity,
  source_name || '_run_' || payload_no AS api_run_id, source_name || CASE source_name WHEN 'gdelt' THEN 'https://example.org/e/' || event_id WHEN 'nws' THEN 'w' || event_id WHEN 'cisa' THEN 'c' WHEN 'cpsc' THEN 'r' || event_id END AS url
FROM dm_ok_items WHERE source_name IN ('gdelt', 'nws', 'cisa', 'cpsc')
UNION ALL SELECT source_name, strftime(fetched, '%Y-%m-%d'), CASE source_name WHEN 'ofac' THEN 'OFAC sanctions file snapshot: ofac_feed' WHEN 'eia' THEN 'EIA fuel price data snapshot' ELSE 'SEC company submissions snapshot: sec_edgar_feed' END,
  CASE source_name WHEN 'ofac' THEN 'high' ELSE 'medium' END, api_run_id, api_run_id FROM fx_payload_runs WHERE source_name IN ('ofac', 'eia', 'sec_edgar')
""")


@query("normalize_events", "M03 W02 U01", "SELECT source_name, event_date, event_title, severity, api_run_id, count(*) AS n FROM dm_normal_events GROUP BY ALL")
def _(t):
    every = E.payload_events(_raw(t))
    twice = every.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")  # every event arrives twice; the dedupe keeps one
    return tidy(E.normalize_events(twice).groupBy("source_name", "event_date", "event_title", "severity", "api_run_id").agg(F.count(F.lit(1)).alias("n")))


@query("split_evidence", "M05 P21", """
SELECT r.api_run_id, sha256(r.api_run_id || '||' || sha256(raw_payload_json)) AS evidence_document_id, substr(raw_payload_json, 1, 200) AS raw_payload_preview, length(raw_payload_json) AS raw_payload_size_chars
FROM fx_raw_gdelt r
""")
def _(t):
    gdelt = E.parse_events(_raw(t), E.ITEM_FEEDS[:1])
    _, evidence = silver.split_evidence(gdelt)
    return tidy(evidence.select("api_run_id", "evidence_document_id", "raw_payload_preview", "raw_payload_size_chars"))


@query("events_view", "M13", """
SELECT source_name, event_title, api_run_id, sha256(api_run_id || '||' || sha256(raw_payload_json)) AS evidence_document_id
FROM (SELECT source_name, title AS event_title, source_name || '_run_' || payload_no AS api_run_id FROM fx_event_rows WHERE source_name = 'gdelt') JOIN fx_raw_gdelt USING (api_run_id)
""")
def _(t):
    gdelt = E.parse_events(_raw(t), E.ITEM_FEEDS[:1])
    events, evidence = silver.split_evidence(gdelt)
    return marts.events_with_evidence(events, evidence).select("source_name", "event_title", "api_run_id", "evidence_document_id")


cte("fx_raw_all", """
SELECT api_run_id, CASE source_name WHEN 'gdelt' THEN '{"articles":[' WHEN 'nws' THEN '{"type":"FeatureCollection","features":[' WHEN 'cisa' THEN '{"vulnerabilities":[' WHEN 'cpsc' THEN '[' ELSE '{"rows":[' END
  || string_agg(item, ',' ORDER BY event_id) || CASE source_name WHEN 'cpsc' THEN ']' ELSE ']}' END AS raw_payload_json
FROM (SELECT source_name, source_name || '_run_' || payload_no AS api_run_id, event_id, CASE source_name
  WHEN 'gdelt' THEN '{"url":"https://example.org/e/' || event_id || '","title":"' || title || '","seendate":"' || strftime(ts, '%Y%m%dT%H%M%SZ') || '","domain":"example.org","language":"English","sourcecountry":"' || country || '"}'
  WHEN 'nws' THEN '{"id":"w' || event_id || '","properties":{"event":"' || event_type || '","severity":"' || CASE sev_word WHEN 'extreme' THEN 'Extreme' WHEN 'moderate' THEN ' moderate' WHEN 'advisory' THEN 'Advisory' ELSE sev_word END
    || '","areaDesc":"' || region || '","headline":"' || title || '","description":"' || title || '","onset":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","senderName":"station"}}'
  WHEN 'cisa' THEN '{"cveID":"CVE-' || event_id || '","vulnerabilityName":"' || title || '","dateAdded":"' || strftime(ts, '%Y-%m-%d') || '","shortDescription":"' || title
    || '","knownRansomwareCampaignUse":"' || CASE WHEN value >= 50 THEN 'Known' ELSE 'Unknown' END || '"}'
  WHEN 'cpsc' THEN '{"RecallNumber":"R' || event_id || '","RecallDate":"' || strftime(ts, '%Y-%m-%d') || '","Title":"' || title || '","Description":"' || title || '","URL":"https://example.org/r/' || event_id || '"}'
  ELSE '{"n":' || event_id || '}' END AS item FROM dm_ok_items)
GROUP BY source_name, api_run_id
""")


def _all_events(t):
    return E.payload_events(_raw(t))


@query("split_evidence_all", "M05 P21", """
SELECT api_run_id, sha256(api_run_id || '||' || sha256(raw_payload_json)) AS evidence_document_id, substr(raw_payload_json, 1, 200) AS raw_payload_preview, length(raw_payload_json) AS raw_payload_size_chars
FROM fx_raw_all
""")
def _(t):
    _, evidence = silver.split_evidence(_all_events(t))
    return tidy(evidence.select("api_run_id", "evidence_document_id", "raw_payload_preview", "raw_payload_size_chars"))


@query("events_view_all", "M13", """
SELECT source_name, event_title, api_run_id, sha256(api_run_id || '||' || sha256(raw_payload_json)) AS evidence_document_id FROM dm_normal_events JOIN fx_raw_all USING (api_run_id)
""")
def _(t):
    events, evidence = silver.split_evidence(_all_events(t))
    return marts.events_with_evidence(events, evidence).select("source_name", "event_title", "api_run_id", "evidence_document_id")


# ---- crosswalk ----------------------------------------------------------------------------------


@query("build_crosswalk", "M06", """
SELECT 'M5_ITEM_' || l_partkey AS canonical_sku_id, 'm5' AS source_system, 'ITEM_' || l_partkey AS source_product_id, 1.0::DOUBLE AS confidence, 'm5_item_id_direct' AS mapping_rule FROM lineitem GROUP BY l_partkey
UNION ALL SELECT 'RET_P_' || l_partkey, 'retail_inventory', 'P_' || l_partkey, 0.9::DOUBLE, 'retail_product_id_direct' FROM lineitem GROUP BY l_partkey
UNION ALL SELECT 'DATACO_' || l_partkey, 'dataco', CAST(l_partkey AS VARCHAR), 0.8::DOUBLE, 'dataco_card_id_direct' FROM lineitem GROUP BY l_partkey
""")
def _(t):
    none = F.lit(None).cast("string")
    m5 = I.sales_daily(t).select(F.col("item_id").alias("product_id"), F.col("item_id").alias("name"), none.alias("category"), none.alias("department"))
    ret = silver.build_inventory(I.inventory(t)).select("product_id", F.col("product_id").alias("name"), "category", none.alias("department"))
    dc = t.lineitem.select(F.col("l_partkey").cast("string").alias("product_id"), none.alias("name"), none.alias("category"), none.alias("department"))
    return X.build_crosswalk({"m5": m5, "retail_inventory": ret, "dataco": dc}).select("canonical_sku_id", "source_system", "source_product_id", "confidence", "mapping_rule")


cte("dm_repaired", """
SELECT canonical_sku_id, source_system, source_product_id, confidence FROM fx_crosswalk WHERE source_system = 'retail_inventory'
UNION ALL SELECT DISTINCT sku_id, 'supplier_internal', sku_id, 1.0::DOUBLE FROM (SELECT sku_id FROM fx_sku_map UNION ALL SELECT sku_id FROM fx_purchase_orders)
  WHERE sku_id NOT IN (SELECT canonical_sku_id FROM fx_crosswalk WHERE source_system = 'retail_inventory')
""")


@query("repair_crosswalk", "M07", "SELECT * FROM dm_repaired")
def _(t):
    partial = I.crosswalk(t).filter("source_system = 'retail_inventory'")
    return X.repair_crosswalk(partial, [I.sku_map(t), I.purchase_orders(t)]).select("canonical_sku_id", "source_system", "source_product_id", "confidence")


@query("dim_skus", "M16 J05 W04", """
SELECT canonical_sku_id, max(source_product_id) FILTER (source_system = 'm5') AS m5_item_id, max(source_product_id) FILTER (source_system = 'retail_inventory') AS retail_product_id,
  max(source_product_id) FILTER (source_system = 'dataco') AS dataco_product_id, max(source_product_name) AS product_name, max(source_category) AS category, max(source_department) AS department,
  max(confidence) AS confidence, count(DISTINCT source_system) AS system_count FROM fx_crosswalk GROUP BY 1
""")
def _(t):
    return tidy(X.dim_skus(I.crosswalk(t)))


@query("pick_by_priority", "W04", """
SELECT canonical_sku_id, source_system, source_product_id, source_category FROM (
  SELECT *, row_number() OVER (PARTITION BY canonical_sku_id ORDER BY CASE source_system WHEN 'm5' THEN 1 WHEN 'supplier_internal' THEN 2 WHEN 'retail_inventory' THEN 3 ELSE 4 END, source_product_id) AS r
  FROM fx_crosswalk WHERE source_system <> 'm5') WHERE r = 1
""")
def _(t):
    return X.pick_by_priority(I.crosswalk(t).filter("source_system <> 'm5'"))


@query("resolve_sku", "M17", "SELECT supplier_id, sku_id, coalesce(canonical_sku_id, sku_id) AS canonical_sku_id FROM fx_sku_map LEFT JOIN (SELECT source_product_id, min(canonical_sku_id) AS canonical_sku_id FROM dm_repaired WHERE source_system = 'supplier_internal' GROUP BY 1) ON sku_id = source_product_id")
def _(t):
    partial = I.crosswalk(t).filter("source_system = 'retail_inventory'")
    m = I.sku_map(t)
    return X.resolve_sku(m, X.repair_crosswalk(partial, [m])).select("supplier_id", "sku_id", "canonical_sku_id")


# ---- views and marts -------------------------------------------------------------------------

cte("dm_network", """
SELECT s.*, coalesce(alias_count, 0) AS alias_count, coalesce(mapped_sku_count, 0) AS mapped_sku_count, coalesce(primary_sku_count, 0) AS primary_sku_count, coalesce(sku_with_alternate_count, 0) AS sku_with_alternate_count,
  avg_dependency_percent, coalesce(purchase_order_count, 0) AS purchase_order_count, coalesce(purchase_order_line_count, 0) AS purchase_order_line_count, avg_po_fill_rate, avg_delivery_delay_days,
  coalesce(late_po_line_count, 0) AS late_po_line_count, c.scorecard_month AS latest_scorecard_month, c.fill_rate AS latest_fill_rate, c.on_time_delivery_rate AS latest_on_time_delivery_rate,
  c.defect_rate AS latest_defect_rate, c.is_deteriorating AS latest_is_deteriorating, coalesce(route_count, 0) AS route_count, coalesce(risk_region_count, 0) AS risk_region_count, avg_standard_transit_days
FROM fx_suppliers s
LEFT JOIN (SELECT supplier_id, count(*) AS alias_count FROM fx_aliases GROUP BY 1) a USING (supplier_id)
LEFT JOIN (SELECT supplier_id, count(DISTINCT sku_id) AS mapped_sku_count, CAST(sum(CAST(is_primary_supplier AS INT)) AS BIGINT) AS primary_sku_count, CAST(sum(CAST(alternate_supplier_available AS INT)) AS BIGINT) AS sku_with_alternate_count, avg(dependency_percent) AS avg_dependency_percent FROM fx_sku_map GROUP BY 1) m USING (supplier_id)
LEFT JOIN (SELECT supplier_id, count(DISTINCT po_id) AS purchase_order_count, count(*) AS purchase_order_line_count, avg(po_fill_rate) AS avg_po_fill_rate, avg(delivery_delay_days) AS avg_delivery_delay_days, CAST(sum(CAST(is_po_late AS INT)) AS BIGINT) AS late_po_line_count FROM dm_pos GROUP BY 1) p USING (supplier_id)
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY scorecard_month DESC) AS r FROM fx_scorecards) WHERE r = 1) c USING (supplier_id)
LEFT JOIN (SELECT supplier_id, count(DISTINCT route_id) AS route_count, count(DISTINCT risk_region) AS risk_region_count, avg(standard_transit_days) AS avg_standard_transit_days FROM fx_routes GROUP BY 1) r USING (supplier_id)
""")


def _network(t):
    return marts.supplier_network(
        I.suppliers(t), I.sku_map(t), silver.build_purchase_orders(I.purchase_orders(t)), I.scorecards(t), I.routes(t), I.aliases(t)
    )


@query("supplier_network", "M12", """
SELECT supplier_id, supplier_name, country, alias_count, mapped_sku_count, primary_sku_count, sku_with_alternate_count, rnd(avg_dependency_percent, 4) AS avg_dependency_percent, purchase_order_count, purchase_order_line_count,
  rnd(avg_po_fill_rate, 4) AS avg_po_fill_rate, rnd(avg_delivery_delay_days, 4) AS avg_delivery_delay_days, late_po_line_count, strftime(latest_scorecard_month, '%Y-%m-%d') AS latest_scorecard_month,
  rnd(latest_fill_rate, 4) AS latest_fill_rate, route_count, risk_region_count, rnd(avg_standard_transit_days, 4) AS avg_standard_transit_days FROM dm_network
""")
def _(t):
    return tidy(
        _network(t).select(
            "supplier_id", "supplier_name", "country", "alias_count", "mapped_sku_count", "primary_sku_count", "sku_with_alternate_count", "avg_dependency_percent", "purchase_order_count",
            "purchase_order_line_count", "avg_po_fill_rate", "avg_delivery_delay_days", "late_po_line_count", "latest_scorecard_month", "latest_fill_rate", "route_count", "risk_region_count", "avg_standard_transit_days",
        )
    )


@query("dim_suppliers", "M15 P20", """
SELECT supplier_id, supplier_name, parent_company, country, region, supplier_category, criticality_tier, rnd(annual_spend, 4) AS annual_spend, single_source_flag, CAST(default_lead_time_days AS BIGINT) AS default_lead_time_days, mapped_sku_count, primary_sku_count, route_count,
  rnd(latest_fill_rate, 4) AS fill_rate, rnd(latest_on_time_delivery_rate, 4) AS on_time_delivery_rate, rnd(latest_defect_rate, 4) AS defect_rate, latest_is_deteriorating AS deterioration_flag FROM dm_network
""")
def _(t):
    return tidy(marts.dim_suppliers(_network(t)))


cte("dm_best_alternate", """
SELECT sku_id, primary_supplier_id AS supplier_id, alternate_supplier_id AS best_alternate_supplier_id, CASE WHEN approved_flag THEN 'approved' ELSE 'pending' END AS alternate_status, switching_cost_level, estimated_switch_days, capacity_available_pct
FROM (SELECT *, row_number() OVER (PARTITION BY sku_id, primary_supplier_id ORDER BY approved_flag DESC, capacity_available_pct DESC, alternate_supplier_id) AS r FROM fx_alternates) WHERE r = 1
""")
cte("dm_dependency", """
SELECT m.supplier_id, m.sku_id, m.sku_id AS canonical_sku_id, dependency_percent, is_primary_supplier, alternate_supplier_available, standard_lead_time_days AS std_lead_time_days, transport_mode, minimum_order_quantity,
  supplier_name, country, criticality_tier, single_source_flag, best_alternate_supplier_id, coalesce(alternate_status, 'none') AS alternate_status, switching_cost_level, estimated_switch_days, capacity_available_pct
FROM fx_sku_map m LEFT JOIN fx_suppliers s ON m.supplier_id = s.supplier_id LEFT JOIN dm_best_alternate a ON m.sku_id = a.sku_id AND m.supplier_id = a.supplier_id
""")


@query("best_alternate", "M18 W03", "SELECT * REPLACE (CAST(estimated_switch_days AS BIGINT) AS estimated_switch_days, rnd(capacity_available_pct, 4) AS capacity_available_pct) FROM dm_best_alternate")
def _(t):
    return tidy(marts.best_alternate(I.alternates(I.sku_map(t))))


def dependency(t):
    """The dependency mart, or what ``keep_dependency`` has written of it."""
    if "dependency" in t.kept:
        return t.kept["dependency"]
    m = I.sku_map(t)
    resolved = m.withColumn("canonical_sku_id", F.col("sku_id"))
    return marts.dependency_mart(resolved, I.suppliers(t), I.alternates(m))


#: What scores, dashboards and lists take from the mart.
SCORED_BY = (
    "supplier_id", "supplier_name", "criticality_tier", "canonical_sku_id", "dependency_percent", "is_primary_supplier", "std_lead_time_days",
    "transport_mode", "alternate_status", "estimated_switch_days",
)


def keep_dependency(t):
    """Write the dependency mart, without the columns no score takes, for a query that reads it several
    times: it stands on the join of all order lines with their orders, which then runs once."""
    if "dependency" not in t.kept:
        t.kept["dependency"] = cut_lineage(dependency(t).select(*SCORED_BY), "dependency")


@query("dependency_mart", "M19 J06", """
SELECT supplier_id, sku_id, canonical_sku_id, rnd(dependency_percent, 4) AS dependency_percent, is_primary_supplier, supplier_name, criticality_tier, best_alternate_supplier_id, alternate_status, switching_cost_level, rnd(capacity_available_pct, 4) AS capacity_available_pct FROM dm_dependency
""")
def _(t):
    return tidy(
        dependency(t).select("supplier_id", "sku_id", "canonical_sku_id", "dependency_percent", "is_primary_supplier", "supplier_name", "criticality_tier", "best_alternate_supplier_id", "alternate_status", "switching_cost_level", "capacity_available_pct")
    )


cte("dm_sales_30d", """
SELECT canonical_sku_id, avg(units_sold) AS avg_daily_units_sold, avg(sell_price) AS avg_sell_price, sum(units_sold * sell_price) AS total_revenue_30d, count(DISTINCT calendar_date) AS days_with_sales, CAST(sum(units_sold) AS BIGINT) AS total_units_30d
FROM fx_sales_daily LEFT JOIN fx_prices USING (store_id, item_id, wm_yr_wk) JOIN fx_crosswalk ON source_product_id = item_id AND source_system = 'm5'
WHERE calendar_date >= DATE '2001-08-01' - 30 GROUP BY 1
""")


def sales30(t):
    # prices of earlier weeks meet none of the sales asked for
    prices = I.prices(t).filter(F.col("wm_yr_wk") >= I.week_number(F.date_sub(F.lit(I.ORDERS_AS_OF).cast("date"), 30)))
    s = marts.sales_price(I.sales_daily(t), silver.build_prices(prices))
    return marts.sales_30d(s, I.crosswalk(t), I.ORDERS_AS_OF)


@query("sales_30d", "M20", "SELECT canonical_sku_id, rnd(avg_daily_units_sold, 4) AS avg_daily_units_sold, rnd(avg_sell_price, 4) AS avg_sell_price, rnd(total_revenue_30d, 4) AS total_revenue_30d, days_with_sales, total_units_30d FROM dm_sales_30d")
def _(t):
    return tidy(sales30(t))


cte("dm_latest_inventory", """
SELECT * FROM (SELECT i.*, c.canonical_sku_id, row_number() OVER (PARTITION BY c.canonical_sku_id ORDER BY inventory_date DESC, store_id, product_id) AS r
  FROM dm_inventory i JOIN fx_crosswalk c ON i.product_id = c.source_product_id AND c.source_system LIKE '%retail%') WHERE r = 1
""")


def latest_inv(t):
    return marts.latest_inventory(marts.inventory_with_sku(silver.build_inventory(I.inventory(t)), I.crosswalk(t)))


@query("latest_inventory", "M21", "SELECT canonical_sku_id, strftime(inventory_date, '%Y-%m-%d') AS inventory_date, store_id, CAST(inventory_level AS BIGINT) AS inventory_level FROM dm_latest_inventory")
def _(t):
    return tidy(latest_inv(t).select("canonical_sku_id", "inventory_date", "store_id", "inventory_level"))


cte("dm_upcoming", """
SELECT count(*) FILTER (is_snap_any_state) AS snap_days_next_14d, count(*) FILTER (is_event_day) AS event_days_next_14d FROM dm_calendar WHERE calendar_date BETWEEN DATE '2001-07-20' AND DATE '2001-07-20' + 14
""")
SPIKE_AS_OF = "2001-07-20"


def upcoming(t):
    return marts.upcoming_days(silver.build_calendar(I.calendar(t)), SPIKE_AS_OF)


@query("upcoming_days", "M22", "SELECT * FROM dm_upcoming")
def _(t):
    return upcoming(t)


cte("dm_features", """
SELECT *, CASE WHEN effective_daily_demand > 0 THEN inventory_level / effective_daily_demand ELSE 999.0 END AS days_of_cover, coalesce(total_revenue_30d, 0) AS sales_exposure_30d,
  CASE WHEN effective_daily_demand > 0 THEN inventory_level / effective_daily_demand ELSE 999.0 END BETWEEN 0 AND 14 AND (snap_days_next_14d > 0 OR event_days_next_14d > 0) AS demand_spike_in_cover_window
FROM (SELECT l.canonical_sku_id, l.inventory_date AS snapshot_date, l.inventory_level, l.demand_forecast, s.avg_daily_units_sold, s.total_revenue_30d, d.category, u.*, coalesce(l.demand_forecast, s.avg_daily_units_sold, 1.0) AS effective_daily_demand
  FROM dm_latest_inventory l LEFT JOIN dm_sales_30d s USING (canonical_sku_id) LEFT JOIN (SELECT canonical_sku_id, max(source_category) AS category FROM fx_crosswalk GROUP BY 1) d USING (canonical_sku_id), dm_upcoming u)
""")


def features(t, apart=False):
    """Stockout features. With ``apart`` the two parts from order lines, a row per SKU, are written first."""
    parts = [latest_inv, sales30]
    latest, sales = [cut_lineage(p(t), p.__name__) if apart else p(t) for p in parts]
    return marts.stockout_features(latest, sales, X.dim_skus(I.crosswalk(t)), upcoming(t))


@query("stockout_features", "M23", """
SELECT canonical_sku_id, category, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, CAST(inventory_level AS BIGINT) AS inventory_level, rnd(effective_daily_demand, 4) AS effective_daily_demand, rnd(days_of_cover, 4) AS days_of_cover, rnd(sales_exposure_30d, 4) AS sales_exposure_30d, demand_spike_in_cover_window FROM dm_features
""")
def _(t):
    return tidy(features(t).select("canonical_sku_id", "category", "snapshot_date", "inventory_level", "effective_daily_demand", "days_of_cover", "sales_exposure_30d", "demand_spike_in_cover_window"))


cte("dm_po_monthly", """
SELECT supplier_id, CAST(date_trunc('month', order_date) AS DATE) AS po_month, count(DISTINCT po_id) AS distinct_po_count, count(po_id) AS po_count, count(po_line_id) AS po_line_count, CAST(sum(CAST(is_po_late AS INT)) AS BIGINT) AS late_po_line_count,
  avg(po_fill_rate) AS avg_po_fill_rate, avg(delivery_delay_days) AS avg_delivery_delay_days FROM dm_pos GROUP BY 1, 2
""")


@query("po_monthly", "M24", "SELECT * REPLACE (strftime(po_month, '%Y-%m-%d') AS po_month, rnd(avg_po_fill_rate, 4) AS avg_po_fill_rate, rnd(avg_delivery_delay_days, 4) AS avg_delivery_delay_days) FROM dm_po_monthly")
def _(t):
    return tidy(marts.po_monthly(silver.build_purchase_orders(I.purchase_orders(t))))


cte("dm_trends", """
SELECT *, coalesce(fill_rate_slope < -0.02 OR otd_slope < -0.02, false) AS deterioration_flag FROM (
  SELECT *, (fill_rate - lag(fill_rate, 2) OVER w) / 2 AS fill_rate_slope, (on_time_delivery_rate - lag(on_time_delivery_rate, 2) OVER w) / 2 AS otd_slope, (defect_rate - lag(defect_rate, 2) OVER w) / 2 AS defect_rate_slope
  FROM fx_scorecards WINDOW w AS (PARTITION BY supplier_id ORDER BY scorecard_month))
""")


@query("scorecard_trends", "M25 W08", "SELECT supplier_id, strftime(scorecard_month, '%Y-%m-%d') AS scorecard_month, rnd(fill_rate_slope, 4) AS fill_rate_slope, rnd(otd_slope, 4) AS otd_slope, rnd(defect_rate_slope, 4) AS defect_rate_slope, deterioration_flag FROM dm_trends")
def _(t):
    return tidy(marts.scorecard_trends(I.scorecards(t)).select("supplier_id", "scorecard_month", "fill_rate_slope", "otd_slope", "defect_rate_slope", "deterioration_flag"))


@query("route_summary", "M26", "SELECT supplier_id, count(route_id) AS route_count, count(DISTINCT origin_country) AS origin_country_count, count(DISTINCT origin_port) AS origin_port_count, count(DISTINCT risk_region) AS risk_region_count FROM fx_routes GROUP BY 1")
def _(t):
    return marts.route_summary(I.routes(t))


def performance(t):
    return marts.performance_mart(
        marts.scorecard_trends(I.scorecards(t)), marts.po_monthly(silver.build_purchase_orders(I.purchase_orders(t))), marts.route_summary(I.routes(t))
    )


@query("performance_mart", "M27 J07", """
SELECT t.supplier_id, strftime(scorecard_month, '%Y-%m-%d') AS scorecard_month, rnd(fill_rate, 4) AS fill_rate, rnd(on_time_delivery_rate, 4) AS on_time_delivery_rate, rnd(defect_rate, 4) AS defect_rate, deterioration_flag,
  coalesce(po_count, 0) AS po_count, coalesce(late_po_line_count, 0) AS late_po_line_count, rnd(avg_po_fill_rate, 4) AS avg_po_fill_rate, coalesce(route_count, 0) AS route_count
FROM dm_trends t LEFT JOIN dm_po_monthly p ON t.supplier_id = p.supplier_id AND t.scorecard_month = p.po_month LEFT JOIN (SELECT supplier_id, count(*) AS route_count FROM fx_routes GROUP BY 1) r ON t.supplier_id = r.supplier_id
""")
def _(t):
    return tidy(performance(t).select("supplier_id", "scorecard_month", "fill_rate", "on_time_delivery_rate", "defect_rate", "deterioration_flag", "po_count", "late_po_line_count", "avg_po_fill_rate", "route_count"))


@query("po_exposure", "V11", """
SELECT p.supplier_id, supplier_name, criticality_tier, status, count(*) AS open_line_count, CAST(sum(quantity_ordered) AS BIGINT) AS units_at_risk FROM fx_purchase_orders p JOIN fx_suppliers s ON p.supplier_id = s.supplier_id WHERE status <> 'received' GROUP BY ALL
""")
def _(t):
    return marts.po_exposure(I.purchase_orders(t), I.suppliers(t))


@query("primary_listing", "V12", """
SELECT m.supplier_id, sku_id, rnd(dependency_percent, 4) AS dependency_percent, supplier_name, criticality_tier FROM fx_sku_map m JOIN fx_suppliers s ON m.supplier_id = s.supplier_id WHERE is_primary_supplier 
""")
def _(t):
    return tidy(marts.primary_listing(I.sku_map(t), I.suppliers(t)))


@query("deteriorating_listing", "V12", """
SELECT c.supplier_id, strftime(scorecard_month, '%Y-%m-%d') AS scorecard_month, rnd(fill_rate, 4) AS fill_rate, rnd(on_time_delivery_rate, 4) AS on_time_delivery_rate, supplier_name FROM fx_scorecards c JOIN fx_suppliers s ON c.supplier_id = s.supplier_id WHERE is_deteriorating 
""")
def _(t):
    return tidy(marts.deteriorating_listing(I.scorecards(t), I.suppliers(t)))


@query("distribution_counts", "V14", "SELECT source_name, risk_category, count(*) AS event_count FROM fx_external_events GROUP BY 1, 2")
def _(t):
    return R.distribution(I.external_events(t), ["source_name", "risk_category"], "event_count")
