"""Dashboards, context snapshots, contract views, answers and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog import alerts as CA
from riskweave.catalog import scoring as CS
from riskweave.catalog import silver as SV
from riskweave.catalog.matching import Matched
from riskweave.catalog.registry import cte, query
from riskweave.catalog.shape import tidy
from riskweave.operators.matching import top_events_per_supplier
from riskweave.plans import alerts as A
from riskweave.plans import context as C
from riskweave.plans import crosswalk as X
from riskweave.plans import evidence as E
from riskweave.plans import inputs as I
from riskweave.plans import monitoring as MO
from riskweave.plans import scoring as S
from riskweave.session import cut_lineage


class Scored:
    """Matched events, supplier scores and explanations of one run, each computed once."""

    def __init__(self, t):
        self.m = Matched(t).kept()
        self.scores = cut_lineage(S.label_scores(CS.composite(t, self.m, apart=True)), "supplier_scores")
        self.explained = S.explanation_log(self.scores, S.top_supplier_events(*self.m.parts, I.EVENTS_AS_OF))

    def top_events(self, k):
        return top_events_per_supplier(S.recent_points(self.m.links, I.EVENTS_AS_OF), self.m.classes, S.event_order(), k)


@query("supplier_dashboard", "V01", """
SELECT l.supplier_id, rnd(overall_risk_score, 4) AS overall_risk_score, risk_band, active_event_count, critical_event_count, coalesce(n, 0) AS impacted_sku_count, coalesce(z, 0) AS no_alternate_skus, driver_1_detail, driver_2_detail, evidence_count
FROM sc_explained l LEFT JOIN (SELECT supplier_id, count(*) AS n, CAST(sum(CAST(alternate_status = 'none' AS INT)) AS BIGINT) AS z FROM dm_dependency WHERE is_primary_supplier GROUP BY 1) USING (supplier_id)
""")
def _(t):
    SV.keep_dependency(t)
    x = Scored(t)
    d = C.supplier_dashboard(I.suppliers(t), x.scores, x.explained, SV.dependency(t))
    return tidy(d.select("supplier_id", "overall_risk_score", "risk_band", "active_event_count", "critical_event_count", "impacted_sku_count", "no_alternate_skus", "driver_1_detail", "driver_2_detail", "evidence_count"))


@query("sku_dashboard", "V02", """
SELECT canonical_sku_id, rnd(stockout_probability, 4) AS stockout_probability, stockout_risk_band, m5_item_id, retail_product_id FROM sc_stockout LEFT JOIN (
  SELECT canonical_sku_id, max(source_product_id) FILTER (source_system = 'm5') AS m5_item_id, max(source_product_id) FILTER (source_system = 'retail_inventory') AS retail_product_id FROM fx_crosswalk GROUP BY 1) USING (canonical_sku_id)
""")
def _(t):
    d = C.sku_dashboard(CS.stockout(t), X.dim_skus(I.crosswalk(t)))
    return tidy(d.select("canonical_sku_id", "stockout_probability", "stockout_risk_band", "m5_item_id", "retail_product_id"))


cte("cx_narrative", """
SELECT supplier_id, concat_ws(' ', 'Supplier ' || supplier_name || ' scores ' || printf('%.1f', overall_risk_score) || ' overall, band ' || risk_band || '.', 'Most of it comes from ' || top_risk_driver || '.',
  'Driver 1: ' || driver_1_detail || '.', 'Driver 2: ' || driver_2_detail || '.', 'Driver 3: ' || driver_3_detail || '.', 'Evidence count: ' || evidence_count || '.', 'Recommended action: ' || recommended_action) AS risk_explanation FROM sc_explained
""")


@query("risk_narrative", "V03", "SELECT * FROM cx_narrative")
def _(t):
    return C.risk_narrative(Scored(t).explained).select("supplier_id", "risk_explanation")


cte("cx_top_skus", """
SELECT supplier_id, string_agg(canonical_sku_id, ',' ORDER BY r) FILTER (r <= 10) AS skus, count(*) AS top_affected_skus_count, count(*) FILTER (stockout_risk_band IN ('critical', 'high')) AS high_risk_sku_count FROM (
  SELECT d.supplier_id, d.canonical_sku_id, stockout_risk_band, row_number() OVER (PARTITION BY d.supplier_id ORDER BY coalesce(stockout_probability, 0) DESC, d.dependency_percent DESC, d.canonical_sku_id) AS r
  FROM dm_dependency d LEFT JOIN sc_stockout s ON d.canonical_sku_id = s.canonical_sku_id) GROUP BY 1
""")


@query("top_skus", "V04 A09", "SELECT * FROM cx_top_skus")
def _(t):
    _, sku = CA.scored(t)
    x = C.top_skus(SV.dependency(t), sku)
    return tidy(x.select("supplier_id", F.array_join(F.transform("top_affected_skus", lambda s: s["canonical_sku_id"]), ",").alias("skus"), "top_affected_skus_count", "high_risk_sku_count"))


cte("cx_events", """
SELECT supplier_id, string_agg(external_event_id || ':' || match_type, ',' ORDER BY r) FILTER (r <= 10) AS events, count(*) AS active_external_event_count, count(*) FILTER (severity IN ('critical', 'high')) AS high_severity_event_count, max(event_date) FILTER (r <= 10) AS latest_external_event_date,
  string_agg(event_title || ' (' || severity || ', ' || strftime(event_date, '%Y-%m-%d') || ')', chr(10) || '- ' ORDER BY r) FILTER (r <= 10) AS event_lines,
  string_agg('[' || r || '] ' || source_name || ' · DOC_' || api_run_id || ' · ' || source_url, chr(10) || '- ' ORDER BY r) FILTER (r <= 10) AS evidence_lines FROM (
  SELECT supplier_id, external_event_id, match_type, severity, event_date, event_title, source_name, api_run_id, source_url, row_number() OVER (PARTITION BY supplier_id ORDER BY points DESC, external_event_id) AS r FROM mt_best JOIN fx_external_events USING (external_event_id) WHERE event_date >= DATE '2024-01-30' - 30) GROUP BY 1
""")


@query("active_events", "V05", "SELECT * EXCLUDE (event_lines, evidence_lines) REPLACE (strftime(latest_external_event_date, '%Y-%m-%d') AS latest_external_event_date) FROM cx_events")
def _(t):
    m = Matched(t).kept()
    top = top_events_per_supplier(S.recent_points(m.links, I.EVENTS_AS_OF), m.classes, S.event_order(), 10)
    x = C.active_events(top, S.active_event_totals(*m.parts, I.EVENTS_AS_OF))
    text = F.array_join(F.transform("active_external_events", lambda e: F.concat_ws(":", e["external_event_id"], e["match_type"])), ",")
    return tidy(x.select("supplier_id", text.alias("events"), "active_external_event_count", "high_severity_event_count", "latest_external_event_date"))


cte("cx_alerts", """
SELECT supplier_id, string_agg(alert_id, ',' ORDER BY r) FILTER (r <= 10) AS alerts, count(*) AS open_alerts_count, count(*) FILTER (severity IN ('critical', 'high')) AS critical_or_high_alert_count FROM (
  SELECT *, row_number() OVER (PARTITION BY supplier_id ORDER BY severity_rank DESC, alert_id) AS r FROM al_all WHERE supplier_id IS NOT NULL) GROUP BY 1
""")


@query("open_alerts", "V06 F07", "SELECT * FROM cx_alerts")
def _(t):
    matched = Matched(t).kept()
    alerts, unlisted = CA.listed(t, matched, *CA.scored(t, matched))
    x = C.open_alerts(alerts, CA.LISTED, unlisted)
    return tidy(x.select("supplier_id", F.array_join(F.transform("open_alerts", lambda a: a["alert_id"]), ",").alias("alerts"), "open_alerts_count", "critical_or_high_alert_count"))


def snapshot(t):
    SV.keep_dependency(t)
    x = Scored(t)
    sku = cut_lineage(CS.stockout(t, x.scores), "sku_scores")
    alerts, unlisted = CA.listed(t, x.m, x.scores, sku)
    parts = [  # a row per supplier, written one after the other: the driver plans and follows one at a time
        lambda: C.risk_narrative(x.explained),
        lambda: C.top_skus(SV.dependency(t), sku),
        lambda: C.active_events(E.with_evidence_documents(cut_lineage(x.top_events(10), "top_events"), I.evidence_documents(t)), cut_lineage(S.active_event_totals(*x.m.parts, I.EVENTS_AS_OF), "event_totals")),
        lambda: C.open_alerts(alerts, CA.LISTED, unlisted),
    ]
    return x, C.context_snapshot(x.scores, *[cut_lineage(p(), "snapshot_part") for p in parts], I.EVENTS_AS_OF)


cte("cx_snapshot", """
SELECT l.supplier_id, l.supplier_name, l.risk_band, l.overall_risk_score, l.top_risk_driver, l.recommended_action, coalesce(open_alerts_count, 0) AS open_alerts_count, coalesce(active_external_event_count, 0) AS active_external_event_count, coalesce(top_affected_skus_count, 0) AS top_affected_skus_count, events, skus, event_lines, evidence_lines,
  'Supplier: ' || l.supplier_name || ' (' || l.supplier_id || ')' || chr(10) || chr(10) || 'Overall score now: ' || printf('%.1f', l.overall_risk_score) || ' | Band: ' || l.risk_band || chr(10) || chr(10) || 'Tier: ' || l.criticality_tier || chr(10) || chr(10)
  || 'Top risk driver: ' || l.top_risk_driver || chr(10) || chr(10) || 'Recommended action: ' || l.recommended_action || chr(10) || chr(10) || 'Open alerts: ' || coalesce(open_alerts_count, 0) || ', of these severe: ' || coalesce(critical_or_high_alert_count, 0) || chr(10) || chr(10)
  || 'Events of the last 30 days: ' || coalesce(active_external_event_count, 0) || ', of these severe: ' || coalesce(high_severity_event_count, 0) || ', newest: ' || coalesce(strftime(latest_external_event_date, '%Y-%m-%d'), 'none') || chr(10) || chr(10)
  || 'SKUs it supplies: ' || coalesce(top_affected_skus_count, 0) || ', of these at risk: ' || coalesce(high_risk_sku_count, 0) || chr(10) || chr(10) || 'Why: ' || risk_explanation AS chat_context_text
FROM sc_labelled l LEFT JOIN cx_narrative USING (supplier_id) LEFT JOIN cx_top_skus USING (supplier_id) LEFT JOIN cx_events USING (supplier_id) LEFT JOIN cx_alerts USING (supplier_id)
""")


@query("context_snapshot", "V07", "SELECT supplier_id, open_alerts_count, active_external_event_count, top_affected_skus_count, chat_context_text, overall_risk_score AS json_score FROM cx_snapshot")
def _(t):
    _, s = snapshot(t)
    return tidy(
        s.select("supplier_id", "open_alerts_count", "active_external_event_count", "top_affected_skus_count", "chat_context_text", F.get_json_object("chat_context_json", "$.overall_risk_score").cast("double").alias("json_score"))
    )


@query("ui_supplier_view", "V08", "SELECT supplier_id, rnd(overall_risk_score, 4) AS risk_score, upper(substr(risk_band, 1, 1)) || substr(risk_band, 2) AS risk_band_label, supplier_name || ' (' || supplier_id || ')' AS display_name FROM sc_composite")
def _(t):
    return tidy(C.ui_supplier_view(CS.composite(t)).select("supplier_id", "risk_score", "risk_band_label", "display_name"))


@query("ui_sku_view", "V08", "SELECT canonical_sku_id, rnd(stockout_probability * 100, 1) AS stockout_percent, stockout_risk_band AS status FROM sc_stockout")
def _(t):
    return tidy(C.ui_sku_view(CS.stockout(t)).select("canonical_sku_id", "stockout_percent", "status"))


@query("adapter_view", "V09 P03", "SELECT supplier_id, supplier_name AS name, country AS location, NULL::DOUBLE AS credit_limit FROM fx_suppliers")
def _(t):
    spec = {"supplier_id": (["supplier_id"], "string"), "name": (["title", "supplier_name"], "string"), "location": (["city", "country"], "string"), "credit_limit": (["credit_limit"], "double")}
    return C.adapter_view(I.suppliers(t), spec)


@query("snapshot_lookup", "V15", """
SELECT DISTINCT 'SUP_' || l_suppkey AS supplier_id, CASE l_suppkey % 4 WHEN 0 THEN 'from column' WHEN 1 THEN 'from json' WHEN 2 THEN 'from text' ELSE 'from evidence' END AS top_risk_driver, 'Review supplier.' AS recommended_action FROM lineitem
""")
def _(t):
    k = F.col("s_suppkey")
    s = t.supplier.select(
        F.concat(F.lit("SUP_"), k.cast("string")).alias("supplier_id"),
        F.when(k % 4 == 0, F.lit("from column")).alias("top_risk_driver"),
        F.lit(None).cast("string").alias("recommended_action"),
        F.when(k % 4 == 1, F.lit('{"top_risk_driver": "from json"}')).otherwise(F.lit("{}")).alias("chat_context_json"),
        F.when(k % 4 == 2, F.lit("Supplier: x\nTop risk driver: from text\n")).alias("chat_context_text"),
    )
    e = t.supplier.select(F.concat(F.lit("SUP_"), k.cast("string")).alias("supplier_id"), F.lit("Top risk driver: from evidence").alias("evidence_text"))
    ids = t.lineitem.select(F.concat(F.lit("SUP_"), F.col("l_suppkey").cast("string")).alias("supplier_id")).distinct()
    return C.snapshot_lookup(ids, s, e)


@query("context_packet", "E14", "SELECT supplier_id AS question_id, supplier_id, risk_band, coalesce(top_affected_skus_count, 0) AS json_skus, event_lines AS json_events, evidence_lines AS json_evidence FROM cx_snapshot")
def _(t):
    _, s = snapshot(t)
    q = I.suppliers(t).select(F.col("supplier_id").alias("question_id"), "supplier_id")
    s = cut_lineage(s.select("supplier_id", "risk_band", "top_affected_skus_count", E.event_lines().alias("event_lines"), E.evidence_lines().alias("evidence_lines")), "packets")
    p = E.context_packet(q, s.drop("event_lines", "evidence_lines"), s.select("supplier_id", "event_lines", "evidence_lines"))
    listed = lambda c: F.array_join(F.from_json(F.get_json_object("packet_json", f"$.{c}"), "array<string>"), "\n- ")
    json_skus = F.get_json_object("packet_json", "$.top_affected_skus_count").cast("long")
    return tidy(p.select("question_id", "supplier_id", "risk_band", json_skus.alias("json_skus"), listed("event_lines").alias("json_events"), listed("evidence_lines").alias("json_evidence")))


cte("cx_answers", """
SELECT supplier_id, risk_band, supplier_name, concat_ws(chr(10), CASE WHEN risk_band NOT IN ('high', 'critical') THEN supplier_name || ' is not classified as high risk; it is classified as ' || risk_band || '.' END,
  supplier_name || ' (' || supplier_id || ') has a risk score of ' || printf('%.1f', overall_risk_score) || ' and is in the ' || risk_band || ' risk band.', 'Top risk driver: ' || top_risk_driver,
  'Active events: ' || active_external_event_count || '; affected SKUs: ' || top_affected_skus_count || '; open alerts: ' || open_alerts_count,
  'Top events:' || chr(10) || '- ' || event_lines, CASE WHEN skus IS NOT NULL THEN 'Affected SKUs:' || chr(10) || '- ' || array_to_string(string_split(skus, ','), chr(10) || '- ') END, 'Evidence:' || chr(10) || '- ' || evidence_lines, 'Recommendation: ' || recommended_action) AS final_answer FROM cx_snapshot
""")


def answers(t):
    _, s = snapshot(t)
    packets = s.select(
        F.col("supplier_id").alias("question_id"), "supplier_id", "supplier_name", "risk_band", "overall_risk_score", "top_risk_driver", "recommended_action",
        F.concat(F.lit("Why is "), "supplier_name", F.lit(" high risk?")).alias("question"),
        F.col("active_external_event_count").alias("event_count"), F.col("top_affected_skus_count").alias("sku_count"), F.col("open_alerts_count").alias("alert_count"),
        E.event_lines().alias("event_lines"),
        F.transform("top_affected_skus", lambda x: x["canonical_sku_id"]).alias("sku_lines"),
        E.evidence_lines().alias("evidence_lines"),
    )
    return E.templated_answer(packets)


@query("templated_answer", "E15", "SELECT supplier_id, final_answer FROM cx_answers")
def _(t):
    return answers(t).select("supplier_id", "final_answer")


@query("score_answers", "N03", """
SELECT supplier_id AS eval_id, rnd(1.0, 4) AS expected_term_coverage, CAST(evidence AS BIGINT) AS evidence_present, rnd((7 + evidence) / 8, 4) AS quality_score FROM (SELECT supplier_id, CAST(active_external_event_count > 0 AS INT) AS evidence FROM cx_snapshot)
""")
def _(t):
    a = cut_lineage(answers(t), "answers")
    cases = a.select(
        F.col("supplier_id").alias("eval_id"), F.col("supplier_id").alias("expected_supplier_id"), F.col("risk_band").alias("expected_risk_band"),
        F.array(F.col("supplier_name"), F.lit(" risk score ")).alias("expected_terms"), F.lit(True).alias("expects_supplier_resolution"),
        (~F.col("risk_band").isin("high", "critical")).alias("expects_assumption_correction"), F.lit(True).alias("expects_evidence"),
    )
    got = a.select(F.col("supplier_id").alias("eval_id"), "supplier_id", F.col("event_count").alias("evidence_count"), "final_answer")
    return tidy(MO.score_answers(cases, got).select("eval_id", "expected_term_coverage", "evidence_present", "quality_score"))


@query("eval_cases", "N04", """
WITH s AS (SELECT supplier_id, supplier_name, risk_band, overall_risk_score FROM sc_composite), b AS (SELECT *, row_number() OVER (PARTITION BY risk_band ORDER BY overall_risk_score DESC, supplier_id) AS r FROM s)
SELECT 'top_risk' AS eval_category, * FROM (SELECT supplier_id AS expected_supplier_id, risk_band AS expected_risk_band FROM s ORDER BY overall_risk_score DESC, supplier_id LIMIT 1)
UNION ALL SELECT 'medium_risk', supplier_id, risk_band FROM b WHERE r = 1 AND risk_band = 'medium' UNION ALL SELECT 'low_risk', supplier_id, risk_band FROM b WHERE r = 1 AND risk_band = 'low' UNION ALL SELECT 'known_supplier', supplier_id, risk_band FROM s WHERE supplier_id = 'SUP_5'
""")
def _(t):
    return MO.eval_cases(cut_lineage(CS.composite(t), "supplier_scores"), "SUP_5").select("eval_category", "expected_supplier_id", "expected_risk_band")


# ---- logs -----------------------------------------------------------------------------------------

cte("mo_logs", """
SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INT) AS k FROM events
""")


def logs(t):
    """Run logs: one per event; the evidence list has as many entries as the event's type name has
    letters to five, and some answers leak an empty slot."""
    k = F.get_json_object("props", "$.k").cast("int")
    item = lambda src, sev: F.format_string(f'{{"source_name":"{src}","risk_category":"cat%d","severity":"{sev}"}}', k % 3)
    return t.events.select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("agent_name"),
        F.when(k % 2 == 0, F.concat(F.lit("SUP_"), F.col("user_id").cast("string"))).alias("supplier_id"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("duration_seconds"),
        F.when(k % 5 == 0, F.lit("[]")).when(k % 5 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("["), item("nws", "High"), F.lit(","), item("gdelt", "medium"), F.lit(","), item("nws", "high"), F.lit("]"))).alias("evidence_json"),
        F.when(k % 7 == 0, F.lit("Top risk driver is None")).when(k % 7 == 1, F.lit("see <?xml version")).when(k % 7 == 2, F.lit(None).cast("string")).otherwise(F.lit("fine")).alias("final_answer"),
    )


@query("run_metrics", "N01 N02", """
SELECT event_id AS run_id, CASE WHEN k % 5 > 1 THEN 3 ELSE 0 END::BIGINT AS evidence_count, CAST(k % 2 = 0 AS BIGINT) AS supplier_resolved, CAST(k % 7 <> 2 AS BIGINT) AS has_final_answer,
  CASE k % 7 WHEN 0 THEN 23 WHEN 1 THEN 17 WHEN 2 THEN 0 ELSE 4 END::BIGINT AS answer_char_length, CASE WHEN k % 5 > 1 THEN 2 ELSE 0 END::BIGINT AS unique_source_count, CASE WHEN k % 5 > 1 THEN 2 ELSE 0 END::BIGINT AS high_severity_evidence_count,
  CAST(k % 7 = 0 AS BIGINT) AS none_leakage_flag, CAST(k % 7 = 1 AS BIGINT) AS raw_payload_leakage_flag FROM mo_logs
""")
def _(t):
    return tidy(
        MO.run_metrics(logs(t)).select("run_id", "evidence_count", "supplier_resolved", "has_final_answer", "answer_char_length", "unique_source_count", "high_severity_evidence_count", "none_leakage_flag", "raw_payload_leakage_flag")
    )


@query("monitoring_summary", "N05 J15 A15", """
SELECT agent_name, total_runs, successful_runs, rnd(d, 4) AS avg_duration_seconds, none_leakage_count, total_eval_rows, rnd(q, 4) AS avg_quality_score FROM (
  SELECT event_type AS agent_name, count(*) AS total_runs, count(*) FILTER (event_type <> 'error') AS successful_runs, avg(value) AS d, count(*) FILTER (k % 7 = 0) AS none_leakage_count FROM mo_logs GROUP BY 1),
  (SELECT count(*) AS total_eval_rows, avg((quality + 1) / 2) AS q FROM labels)
""")
def _(t):
    q = F.col("quality")
    evals = t.labels.select(((q + 1) / 2).alias("quality_score"), q.alias("supplier_resolution_correct"), q.alias("expected_term_coverage"), q.alias("evidence_present"))
    s = MO.monitoring_summary(MO.run_metrics(logs(t)), evals, ["agent_name"])
    return tidy(s.select("agent_name", "total_runs", "successful_runs", "avg_duration_seconds", "none_leakage_count", "total_eval_rows", "avg_quality_score"))


@query("serving_summary", "N06 J16 A05", """
SELECT agent_name, total_requests, successful_requests, rnd(success_rate, 4) AS success_rate, rnd(d, 4) AS avg_duration_seconds, distinct_suppliers_served, latest_total_checks, latest_passed_checks FROM (
  SELECT event_type AS agent_name, count(*) AS total_requests, count(*) FILTER (event_type <> 'error') AS successful_requests, count(*) FILTER (event_type <> 'error') / count(*) AS success_rate, avg(value) AS d, count(DISTINCT CASE WHEN k % 2 = 0 THEN user_id END) AS distinct_suppliers_served FROM mo_logs GROUP BY 1),
  (SELECT count(*) AS latest_total_checks, count(*) FILTER (turn < 2) AS latest_passed_checks FROM conversations WHERE conv_id = (SELECT max(conv_id) FROM conversations))
""")
def _(t):
    log = logs(t)
    responses = log.select(F.col("run_id").alias("request_id"), "ok", "duration_seconds", "supplier_id")
    requests = log.select(F.col("run_id").alias("request_id"), "agent_name")
    health = t.conversations.select(F.col("conv_id").alias("health_run_id"), F.col("conv_id").alias("finished_at"), (F.col("turn") < 2).alias("passed"))
    s = MO.serving_summary(responses, requests, health, ["agent_name"])
    return tidy(s.select("agent_name", "total_requests", "successful_requests", "success_rate", "avg_duration_seconds", "distinct_suppliers_served", "latest_total_checks", "latest_passed_checks"))


@query("run_status", "N07", """
SELECT o_orderkey AS run_id, count(*) AS task_count, count(*) FILTER (l_linestatus = 'O' AND l_returnflag <> 'N') AS running_tasks, count(*) FILTER (l_linestatus = 'F') AS terminated_tasks, count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'R') AS failed_tasks,
  CASE WHEN count(*) FILTER (l_linestatus = 'F' AND l_returnflag = 'R') > 0 THEN 'FAILED' WHEN count(*) FILTER (l_linestatus = 'O' AND l_returnflag <> 'N') > 0 THEN 'RUNNING' ELSE 'SUCCESS' END AS run_status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def _(t):
    tasks = t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").cast("string").alias("task_key"),
        F.when(F.col("l_linestatus") == "F", F.lit("terminated")).when(F.col("l_returnflag") == "N", F.lit("skipped")).otherwise(F.lit("running")).alias("task_state"),
        F.when(F.col("l_returnflag") == "R", F.lit("failed")).otherwise(F.lit("success")).alias("result_state"),
    )
    return tidy(MO.run_status(tasks).select("run_id", "task_count", "running_tasks", "terminated_tasks", "failed_tasks", "run_status"))


@query("health_rollup", "N08", """
SELECT conv_id AS health_run_id, turn, count(*) OVER w AS total_checks, CAST(sum(CAST(length(text) < 400 AS INT)) OVER w AS BIGINT) AS passed_checks, sum(CAST(length(text) < 400 AS INT)) OVER w = count(*) OVER w AS overall_healthy FROM conversations WINDOW w AS (PARTITION BY conv_id)
""")
def _(t):
    checks = t.conversations.select(F.col("conv_id").alias("health_run_id"), "turn", (F.length("text") < 400).alias("passed"))
    return MO.health_rollup(checks).select("health_run_id", "turn", "total_checks", "passed_checks", "overall_healthy")


@query("turn_pairs", "N01", "SELECT conv_id, turn, text AS question, answer FROM (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND nr = 'assistant'")
def _(t):
    return MO.turn_pairs(t.conversations)


@query("top_suppliers_by_score", "V14 T06", "SELECT supplier_id, rnd(operational_score, 4) AS operational_score FROM sc_operational ORDER BY sc_operational.operational_score DESC, supplier_id LIMIT 10")
def _(t):
    return tidy(CS.operational(t).select("supplier_id", "operational_score").orderBy(F.desc("operational_score"), "supplier_id").limit(10))

