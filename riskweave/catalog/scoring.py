"""Supplier and stockout risk scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog import silver as CS
from riskweave.catalog.matching import Matched
from riskweave.catalog.registry import cte, query
from riskweave.catalog.shape import tidy
from riskweave.plans import inputs as I
from riskweave.plans import marts
from riskweave.plans import scoring as S
from riskweave.session import cut_lineage

cte("sc_operational", """
SELECT supplier_id, scorecard_month, fill_rate, on_time_delivery_rate, defect_rate, deterioration_flag,
  least(100.0, greatest(0.0, (1 - fill_rate) * 35.0 + (1 - on_time_delivery_rate) * 30.0 + defect_rate * 100.0 + CASE WHEN deterioration_flag THEN 2.25 ELSE 0.0 END)) AS operational_score
FROM (SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY scorecard_month DESC) AS r FROM dm_trends) WHERE r = 1
""")
cte("sc_dependency", """
SELECT s.supplier_id, coalesce(n, 0) AS total_sku_count, coalesce(no_alt, 0) AS no_alternate_sku_count, coalesce(a, 0.5) AS avg_dependency_pct,
  least(100.0, greatest(0.0, CASE WHEN single_source_flag THEN 40.0 ELSE 0.0 END + coalesce(a, 0.5) * 30.0 + CASE WHEN n > 0 THEN no_alt / n * 20.0 ELSE 0.0 END + CASE criticality_tier WHEN 'Tier 1' THEN 10.0 WHEN 'Tier 2' THEN 5.0 ELSE 0.0 END)) AS dependency_score
FROM fx_suppliers s LEFT JOIN (SELECT supplier_id, count(*) AS n, avg(dependency_percent) AS a, CAST(sum(CAST(alternate_status = 'none' AS INT)) AS BIGINT) AS no_alt FROM dm_dependency WHERE is_primary_supplier GROUP BY 1) d USING (supplier_id)
""")
cte("sc_logistics", """
SELECT supplier_id, count(*) AS route_count, count(*) FILTER (transport_mode = 'ocean') AS ocean_route_count, count(DISTINCT risk_region) AS distinct_risk_regions,
  least(100.0, count(*) FILTER (transport_mode = 'ocean') / count(*) * 40.0 + least(count(DISTINCT risk_region) * 15.0, 60.0)) AS logistics_score FROM fx_routes GROUP BY 1
""")
cte("sc_composite", """
SELECT *, CASE WHEN overall_risk_score >= 75 THEN 'critical' WHEN overall_risk_score >= 55 THEN 'high' WHEN overall_risk_score >= 35 THEN 'medium' ELSE 'low' END AS risk_band FROM (
SELECT s.supplier_id, supplier_name, country, criticality_tier, single_source_flag, coalesce(operational_score, 0) AS operational_score, coalesce(dependency_score, 0) AS dependency_score, coalesce(external_event_score, 0) AS external_event_score,
  coalesce(logistics_score, 0) AS logistics_score, coalesce(sanctions_score, 0) AS sanctions_score, coalesce(cyber_score, 0) AS cyber_score, deterioration_flag, coalesce(active_event_count, 0) AS active_event_count, coalesce(critical_event_count, 0) AS critical_event_count,
  coalesce(total_sku_count, 0) AS total_sku_count, coalesce(no_alternate_sku_count, 0) AS no_alternate_sku_count,
  rnd(coalesce(operational_score, 0) * 0.25 + coalesce(dependency_score, 0) * 0.20 + coalesce(external_event_score, 0) * 0.20 + coalesce(logistics_score, 0) * 0.15 + coalesce(sanctions_score, 0) * 0.10 + coalesce(cyber_score, 0) * 0.10, 1) AS overall_risk_score
FROM fx_suppliers s LEFT JOIN sc_operational o USING (supplier_id) LEFT JOIN sc_dependency d USING (supplier_id) LEFT JOIN mt_event_scores e USING (supplier_id) LEFT JOIN sc_logistics l USING (supplier_id))
""")
cte("sc_labelled", """
SELECT *, CASE WHEN external_event_score * 0.20 = top THEN 'External events' WHEN dependency_score * 0.20 = top THEN 'Supplier dependency' WHEN sanctions_score > 0 THEN 'OFAC sanctions match'
    WHEN operational_score * 0.25 >= logistics_score * 0.15 THEN 'Operational performance decline' ELSE 'Logistics / route risk' END AS top_risk_driver,
  CASE WHEN risk_band = 'critical' AND single_source_flag AND no_alternate_sku_count > 0 THEN 'Escalate immediately — no fallback exists' WHEN risk_band = 'critical' AND no_alternate_sku_count = 0 THEN 'Initiate supplier switch — alternate pre-qualified'
    WHEN risk_band = 'critical' THEN 'Expedite open POs and escalate to procurement lead' WHEN risk_band = 'high' AND deterioration_flag THEN 'Schedule supplier review — scorecard trend declining'
    WHEN risk_band = 'high' THEN 'Monitor closely — external event in progress' WHEN risk_band = 'medium' THEN 'Monitor — no immediate action required' ELSE 'No action required' END AS recommended_action
FROM (SELECT *, greatest(operational_score * 0.25, dependency_score * 0.20, external_event_score * 0.20, logistics_score * 0.15, sanctions_score * 0.10, cyber_score * 0.10) AS top FROM sc_composite)
""")


def trends(t):
    """Monthly scorecards with their trends, or what ``keep_trends`` has written of them."""
    return t.kept["trends"] if "trends" in t.kept else marts.scorecard_trends(I.scorecards(t))


def keep_trends(t):
    """Write what scores take of the trends, for a query that reads them several times: they stand on the join
    of all order lines with their orders."""
    if "trends" not in t.kept:
        t.kept["trends"] = cut_lineage(trends(t).select("supplier_id", "scorecard_month", "fill_rate", "on_time_delivery_rate", "defect_rate", "deterioration_flag"), "trends")


def operational(t):
    return S.operational_score(trends(t))


def composite(t, matched=None, apart=False):
    """The composite score. With ``apart`` each sub-score, a row per supplier, is written first: the driver then
    plans and follows one of them at a time."""
    if apart:
        I.keep_named(t)
    s = I.suppliers(t)
    parts = [
        lambda: operational(t),
        lambda: S.dependency_score(s, CS.dependency(t)),
        lambda: S.event_scores(*(matched or Matched(t)).parts, I.EVENTS_AS_OF),
        lambda: S.logistics_score(I.routes(t)),
    ]
    return S.composite_score(s, [cut_lineage(p(), "sub_score") if apart else p() for p in parts], I.EVENTS_AS_OF)


def history(t):
    """Earlier scores: the operational score of every month, dated by month."""
    months = S.monthly_operational_score(trends(t))
    return months.select("supplier_id", F.col("scorecard_month").alias("score_date"), F.col("operational_score").alias("overall_risk_score"))


@query("rank_suppliers", "R01 R08 W01 M25", """
SELECT s.supplier_id, supplier_name, country, strftime(scorecard_month, '%Y-%m-%d') AS scorecard_month, rnd(operational_score, 4) AS operational_score,
  CASE WHEN operational_score >= 75 THEN 'critical' WHEN operational_score >= 55 THEN 'high' WHEN operational_score >= 35 THEN 'medium' ELSE 'low' END AS risk_band, deterioration_flag
FROM sc_operational JOIN fx_suppliers s USING (supplier_id)
""")
def rank_suppliers(t):
    """Suppliers by operational risk: lines to monthly scorecards to trend to latest month to band."""
    s = I.suppliers(t).select("supplier_id", "supplier_name", "country")
    scored = operational(t).withColumn("risk_band", S.band(F.col("operational_score"), S.SUPPLIER_BANDS))
    out = scored.join(s, "supplier_id").select(
        "supplier_id", "supplier_name", "country", "scorecard_month", "operational_score", "risk_band", "deterioration_flag"
    )
    return tidy(out).orderBy(F.desc("operational_score"), "supplier_id")


@query("operational_score", "R01", "SELECT supplier_id, rnd(fill_rate, 4) AS fill_rate, rnd(on_time_delivery_rate, 4) AS on_time_delivery_rate, rnd(operational_score, 4) AS operational_score FROM sc_operational")
def _(t):
    return tidy(operational(t).select("supplier_id", "fill_rate", "on_time_delivery_rate", "operational_score"))


@query("dependency_score", "R02", "SELECT supplier_id, total_sku_count, no_alternate_sku_count, rnd(avg_dependency_pct, 4) AS avg_dependency_pct, rnd(dependency_score, 4) AS dependency_score FROM sc_dependency")
def _(t):
    return tidy(S.dependency_score(I.suppliers(t), CS.dependency(t)))


@query("logistics_score", "R04", "SELECT supplier_id, route_count, ocean_route_count, distinct_risk_regions, rnd(logistics_score, 4) AS logistics_score FROM sc_logistics")
def _(t):
    return tidy(S.logistics_score(I.routes(t)))


@query("composite_score", "R07 R08", "SELECT supplier_id, rnd(overall_risk_score, 4) AS overall_risk_score, risk_band FROM sc_composite")
def _(t):
    return tidy(composite(t).select("supplier_id", "overall_risk_score", "risk_band"))


cte("sc_history", "SELECT supplier_id, scorecard_month AS score_date, least(100.0, greatest(0.0, (1 - fill_rate) * 35.0 + (1 - on_time_delivery_rate) * 30.0 + defect_rate * 100.0 + CASE WHEN deterioration_flag THEN 2.25 ELSE 0.0 END)) AS overall_risk_score FROM dm_trends")


cte("sc_delta", """
SELECT o.supplier_id, coalesce(rnd(operational_score - p1, 1), 0) AS d, coalesce(rnd(operational_score - p7, 1), 0) AS d7 FROM sc_operational o LEFT JOIN (
  SELECT h.supplier_id, arg_max(overall_risk_score, score_date) AS p1, arg_max(overall_risk_score, score_date) FILTER (score_date <= scorecard_month - 7) AS p7
  FROM sc_history h JOIN sc_operational c USING (supplier_id) WHERE score_date < scorecard_month GROUP BY 1) p USING (supplier_id)
""")


def deltas(t):
    """Change of the operational score against its own earlier months."""
    cur = operational(t).select("supplier_id", F.col("scorecard_month").alias("score_date"), F.col("operational_score").alias("overall_risk_score"))
    return S.score_delta(cur, history(t))


@query("score_delta", "R09 J17", "SELECT supplier_id, rnd(d, 4) AS score_delta_24h, rnd(d7, 4) AS score_delta_7d FROM sc_delta")
def _(t):
    return tidy(deltas(t).select("supplier_id", "score_delta_24h", "score_delta_7d"))


@query("driver_and_action", "R10 R11", "SELECT supplier_id, rnd(overall_risk_score, 4) AS overall_risk_score, top_risk_driver, recommended_action FROM sc_labelled")
def _(t):
    return tidy(S.label_scores(composite(t)).select("supplier_id", "overall_risk_score", "top_risk_driver", "recommended_action"))


cte("sc_explained", """
SELECT l.*, top_risk_driver AS driver_1_dimension, coalesce(e1, 'No event in the last 30 days') AS driver_1_detail,
  CASE WHEN deterioration_flag THEN 'Operational performance decline' WHEN dependency_score > 50 THEN 'High supplier dependency' ELSE 'Logistics risk' END AS driver_2_dimension,
  coalesce(e2, CASE WHEN deterioration_flag THEN 'Scorecards have fallen for three months' END, 'Routes and transport') AS driver_2_detail, e3 AS driver_3_detail, coalesce(n, 0) AS evidence_count, ids AS evidence_ids
FROM sc_labelled l LEFT JOIN (SELECT supplier_id, count(*) AS n, string_agg(external_event_id, ',' ORDER BY r) AS ids, max(line) FILTER (r = 1) AS e1, max(line) FILTER (r = 2) AS e2, max(line) FILTER (r = 3) AS e3
  FROM (SELECT *, source_name || ' · ' || event_title || ' · +' || points || ' pts' AS line FROM mt_top_events) GROUP BY 1) USING (supplier_id)
""")


def explained(t):
    m = Matched(t).kept()
    return S.explanation_log(S.label_scores(composite(t, m)), S.top_supplier_events(*m.parts, I.EVENTS_AS_OF))


@query("explanation_log", "R12", "SELECT supplier_id, driver_1_dimension, driver_1_detail, driver_2_dimension, driver_2_detail, driver_3_detail, evidence_count, evidence_ids FROM sc_explained")
def _(t):
    return tidy(
        explained(t).select(
            "supplier_id", "driver_1_dimension", "driver_1_detail", "driver_2_dimension", "driver_2_detail", "driver_3_detail", "evidence_count", F.array_join("evidence_ids", ",").alias("evidence_ids")
        )
    )


cte("sc_primary", """
SELECT canonical_sku_id, d.supplier_id, d.supplier_name, dependency_percent, std_lead_time_days, alternate_status, overall_risk_score AS linked_supplier_risk_score, risk_band AS linked_supplier_risk_band,
  rnd(std_lead_time_days * (1 + coalesce(logistics_score, 0) / 100.0 * 0.5), 1) AS adjusted_lead_time_days
FROM dm_dependency d LEFT JOIN sc_composite c ON d.supplier_id = c.supplier_id WHERE is_primary_supplier
""")


@query("primary_supplier_risk", "R13", "SELECT canonical_sku_id, supplier_id, CAST(std_lead_time_days AS BIGINT) AS std_lead_time_days, rnd(linked_supplier_risk_score, 4) AS linked_supplier_risk_score, linked_supplier_risk_band, rnd(adjusted_lead_time_days, 4) AS adjusted_lead_time_days FROM sc_primary")
def _(t):
    CS.keep_dependency(t)
    p = S.primary_supplier_risk(CS.dependency(t), composite(t))
    return tidy(p.select("canonical_sku_id", "supplier_id", "std_lead_time_days", "linked_supplier_risk_score", "linked_supplier_risk_band", "adjusted_lead_time_days"))


cte("sc_stockout", """
SELECT *, coalesce(rnd(1 / (1 + exp(-x)), 3), 0) AS stockout_probability, CASE WHEN coalesce(rnd(1 / (1 + exp(-x)), 3), 0) >= 0.75 THEN 'critical' WHEN coalesce(rnd(1 / (1 + exp(-x)), 3), 0) >= 0.5 THEN 'high' WHEN coalesce(rnd(1 / (1 + exp(-x)), 3), 0) >= 0.25 THEN 'medium' ELSE 'low' END AS stockout_risk_band,
  CASE WHEN days_of_cover < 90 THEN DATE '2001-08-01' + CAST(trunc(days_of_cover) AS INTEGER) END AS expected_stockout_date
FROM (SELECT f.*, p.* EXCLUDE (canonical_sku_id), adjusted_lead_time_days - days_of_cover AS cover_gap,
  ((adjusted_lead_time_days - days_of_cover) * 0.30 + coalesce(linked_supplier_risk_score, 0) * 0.02 + CASE alternate_status WHEN 'none' THEN 1.5 WHEN 'pending' THEN 0.5 ELSE 0 END) * CASE WHEN demand_spike_in_cover_window THEN 1.3 ELSE 1.0 END AS x
  FROM dm_features f LEFT JOIN sc_primary p ON f.canonical_sku_id = p.canonical_sku_id)
""")


def stockout(t, scores=None):
    """Stockout scores. What they stand on is written part by part, as in ``composite``."""
    if scores is None:  # then the mart is read twice
        CS.keep_dependency(t)
    scores = scores if scores is not None else cut_lineage(composite(t, apart=True), "supplier_scores")
    primary = cut_lineage(S.primary_supplier_risk(CS.dependency(t), scores), "primary")
    return S.stockout_scores(CS.features(t, apart=True), primary, I.ORDERS_AS_OF)


@query("stockout_scores", "R14 R15", """
SELECT canonical_sku_id, supplier_id, rnd(days_of_cover, 4) AS days_of_cover, rnd(cover_gap, 4) AS cover_gap, rnd(stockout_probability, 4) AS stockout_probability, stockout_risk_band, strftime(expected_stockout_date, '%Y-%m-%d') AS expected_stockout_date, rnd(sales_exposure_30d, 4) AS sales_exposure_30d FROM sc_stockout
""")
def _(t):
    return tidy(stockout(t).select("canonical_sku_id", "supplier_id", "days_of_cover", "cover_gap", "stockout_probability", "stockout_risk_band", "expected_stockout_date", "sales_exposure_30d"))
