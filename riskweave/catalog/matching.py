"""Events matched to suppliers.

The SQL states the rules as plain pairs of every event with every supplier, so it also proves
that the group-grain plans lose and double nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from riskweave.catalog import silver as SV
from riskweave.catalog.registry import block, cte, query
from riskweave.catalog.shape import tidy
from riskweave.functions.risk import severity_points
from riskweave.operators import matching as M
from riskweave.plans import events as E
from riskweave.plans import inputs as I
from riskweave.plans import scoring as S
from riskweave.plans import silver
from riskweave.session import cut_lineage


def plain_sql(x: str) -> str:
    return f"' ' || trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')) || ' '"


cte("mt_texts", f"SELECT external_event_id, {plain_sql('event_title')} AS pt, {plain_sql('event_summary')} AS ps FROM fx_external_events")
cte("mt_alias_words", f"SELECT *, {plain_sql('alias_name')} AS w FROM fx_aliases")
cte("mt_name_words", f"SELECT DISTINCT supplier_id, supplier_name, {plain_sql('supplier_name')} AS w FROM fx_suppliers")
cte("mt_alias", """
SELECT DISTINCT external_event_id, supplier_id, 'alias' AS match_type, alias_name AS match_value, match_confidence
FROM mt_texts JOIN mt_alias_words ON contains(pt, w) OR contains(ps, w)
""")
cte("mt_name", """
SELECT DISTINCT external_event_id, supplier_id, 'name' AS match_type, supplier_name AS match_value, 0.85::DOUBLE AS match_confidence
FROM mt_texts JOIN mt_name_words ON contains(pt, w) OR contains(ps, w)
""")
cte("mt_country", """
SELECT external_event_id, supplier_id, 'country' AS match_type, lower(country) AS match_value, 0.65::DOUBLE AS match_confidence
FROM fx_external_events JOIN fx_suppliers ON lower(event_country) = lower(country) WHERE source_name IN ('nws', 'gdelt', 'ofac', 'sec', 'sec_edgar')
""")
cte("mt_region", """
SELECT DISTINCT external_event_id, supplier_id, 'region' AS match_type, lower(risk_region) AS match_value, 0.60::DOUBLE AS match_confidence
FROM fx_external_events JOIN fx_routes ON contains(lower(event_region), lower(risk_region)) OR contains(lower(risk_region), lower(event_region)) WHERE source_name IN ('nws', 'gdelt')
""")
cte("mt_category", """
SELECT DISTINCT e.external_event_id, supplier_id, 'category' AS match_type, lower(supplier_category) AS match_value, 0.55::DOUBLE AS match_confidence
FROM fx_external_events e JOIN mt_texts x USING (external_event_id) JOIN fx_suppliers s
  ON contains(pt, ' ' || lower(supplier_category) || ' ') OR contains(ps, ' ' || lower(supplier_category) || ' ') OR contains(lower(supplier_category), lower(risk_category)) WHERE source_name = 'cpsc'
""")
cte("mt_fuel", """
SELECT DISTINCT external_event_id, supplier_id, 'fuel_logistics' AS match_type, 'ocean_or_truck_route' AS match_value, 0.50::DOUBLE AS match_confidence
FROM fx_external_events, (SELECT DISTINCT supplier_id FROM fx_routes WHERE transport_mode IN ('ocean', 'truck')) WHERE source_name = 'eia'
""")
cte("mt_scope_pairs", "SELECT * FROM mt_country UNION ALL SELECT * FROM mt_region UNION ALL SELECT * FROM mt_category UNION ALL SELECT * FROM mt_fuel")
cte("mt_best", """
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY external_event_id, supplier_id ORDER BY match_confidence DESC, match_type, match_value) AS r
FROM (SELECT * FROM mt_alias UNION ALL SELECT * FROM mt_name UNION ALL SELECT * FROM mt_scope_pairs)) WHERE r = 1
""")


class Matched:
    """Events with their links to suppliers, and supplier classes. Nothing runs here, but in ``kept``; branches
    of a query share what they have in common."""

    def __init__(self, t, events=None):
        self.t, self.events = t, events
        suppliers, routes = I.suppliers(t), I.routes(t)
        self.links = M.event_links(I.external_events(t) if events is None else events, I.aliases(t), suppliers, routes)
        self.classes = M.supplier_classes(M.supplier_scopes(suppliers, routes))

    def kept(self):
        """The same, written as tables, for queries that read the links several times. The matching then runs
        once; whole texts are not kept."""
        I.keep_named(self.t)
        self.__init__(self.t, self.events)
        self.links = cut_lineage(self.links.drop("event_summary"), "links")
        self.classes = M.Classes(*[cut_lineage(x, "classes") for x in self.classes])
        return self

    @property
    def parts(self):
        return self.links, self.classes


@query("match_alias", "M28 J10", "SELECT * FROM mt_alias")
def _(t):
    return tidy(M.match_alias(I.external_events(t), I.aliases(t)))


@query("match_name", "M29 J10", "SELECT * FROM mt_name")
def _(t):
    return tidy(M.match_name(I.external_events(t), I.suppliers(t)))


def _scope_sql(block: str, members: str) -> str:
    return f"SELECT external_event_id, match_type AS scope_type, match_value AS scope_value, count(DISTINCT supplier_id) AS supplier_count FROM {block} GROUP BY 1, 2, 3{members}"


def _sized(scopes, t):
    """Group matches with the number of suppliers in each scope; scopes no supplier has drop out."""
    sizes = M.supplier_scopes(I.suppliers(t), I.routes(t)).groupBy("scope_type", "scope_value").agg(F.count(F.lit(1)).alias("supplier_count"))
    return scopes.join(sizes, ["scope_type", "scope_value"]).select("external_event_id", "scope_type", "scope_value", "supplier_count")


@query("match_country", "M30 J12", _scope_sql("mt_country", ""))
def _(t):
    return _sized(M.match_country(I.external_events(t)), t)


@query("match_region", "M31 J11", _scope_sql("mt_region", ""))
def _(t):
    return _sized(M.match_region(I.external_events(t), I.routes(t)), t)


@query("match_category", "M32 J10", _scope_sql("mt_category", ""))
def _(t):
    return _sized(M.match_category(I.external_events(t), I.suppliers(t)), t)


@query("match_fuel", "M33 J13", _scope_sql("mt_fuel", ""))
def _(t):
    return _sized(M.match_fuel(I.external_events(t)), t)


@query("best_matches", "M34 W05 U02", """
SELECT external_event_id, supplier_id, match_type, match_value, match_confidence FROM (SELECT *, row_number() OVER (PARTITION BY external_event_id, supplier_id ORDER BY match_confidence DESC, match_type, match_value) AS r
FROM (SELECT * FROM mt_alias UNION ALL SELECT * FROM mt_name)) WHERE r = 1
""")
def _(t):
    return M.match_texts(I.external_events(t), I.aliases(t), I.suppliers(t))


cte("mt_mart", """
SELECT e.*, b.supplier_id AS matched_supplier_id, coalesce(b.match_type, g.gt, 'none') AS match_type, b.match_value, coalesce(b.match_confidence, g.gc) AS match_confidence, coalesce(g.n, 0) AS group_supplier_count,
  coalesce(k.n, 0) AS matched_sku_count, CASE WHEN b.supplier_id IS NOT NULL OR g.n IS NOT NULL THEN points END AS score_contribution, 'DOC_' || e.api_run_id AS evidence_doc_id
FROM fx_external_events e
LEFT JOIN (SELECT * FROM mt_best WHERE (external_event_id, supplier_id) IN (SELECT external_event_id, supplier_id FROM mt_alias UNION SELECT external_event_id, supplier_id FROM mt_name)) b USING (external_event_id)
LEFT JOIN (SELECT external_event_id, count(DISTINCT supplier_id) AS n, max(match_confidence) AS gc, arg_max(match_type, match_confidence) AS gt FROM mt_scope_pairs GROUP BY 1) g USING (external_event_id)
LEFT JOIN (SELECT supplier_id, count(sku_id) AS n FROM fx_sku_map GROUP BY 1) k ON b.supplier_id = k.supplier_id
""")


def sku_counts(t):
    skus = t.lineitem.select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("matched_sku_count"))
    return skus.select(F.concat(F.lit("SUP_"), F.col("l_suppkey").cast("string")).alias("supplier_id"), "matched_sku_count")


def mart(t, matched=None):
    m = matched or Matched(t)
    return M.event_mart(m.links, m.classes, sku_counts(t), I.evidence_documents(t))


@query("event_mart", "M35", """
SELECT external_event_id, source_name, severity, strftime(event_date, '%Y-%m-%d') AS event_date, matched_supplier_id, match_type, match_value, match_confidence, group_supplier_count, matched_sku_count, CAST(score_contribution AS BIGINT) AS score_contribution, evidence_doc_id FROM mt_mart
""")
def _(t):
    return tidy(
        mart(t).select("external_event_id", "source_name", "severity", "event_date", "matched_supplier_id", "match_type", "match_value", "match_confidence", "group_supplier_count", "matched_sku_count", "score_contribution", "evidence_doc_id")
    )


# The same rules over events that come from the payloads: one key per item or payload.
cte("pm_events", """
SELECT source_name || '/' || event_id AS external_event_id, CASE source_name WHEN 'gdelt' THEN 'news_disruption' WHEN 'nws' THEN 'weather_logistics' WHEN 'cisa' THEN 'cyber' ELSE 'quality_recall' END AS risk_category, source_name,
  CASE WHEN source_name = 'cisa' THEN 'CVE-' || event_id || ' - ' || title ELSE title END AS event_title, title AS event_summary, CAST(event_date AS DATE) AS event_date, source_name || '_run_' || payload_no AS api_run_id,
  CASE source_name WHEN 'nws' THEN CASE sev_word WHEN 'extreme' THEN 'critical' WHEN 'severe' THEN 'high' WHEN 'moderate' THEN 'medium' WHEN 'advisory' THEN 'medium' WHEN 'minor' THEN 'low' ELSE 'unknown' END
    WHEN 'cisa' THEN CASE WHEN value >= 50 THEN 'high' ELSE 'medium' END ELSE 'medium' END AS severity,
  CASE WHEN source_name = 'gdelt' THEN country ELSE 'US' END AS event_country, CASE WHEN source_name = 'nws' THEN region END AS event_region
FROM dm_ok_items WHERE source_name IN ('gdelt', 'nws', 'cisa', 'cpsc')
UNION ALL SELECT r.api_run_id, CASE source_name WHEN 'ofac' THEN 'sanctions_compliance' WHEN 'eia' THEN 'fuel_logistics_cost' ELSE 'financial_filing' END, source_name,
  CASE source_name WHEN 'ofac' THEN 'OFAC sanctions file snapshot: ofac_feed' WHEN 'eia' THEN 'EIA fuel price data snapshot' ELSE 'SEC company submissions snapshot: sec_edgar_feed' END,
  CASE source_name WHEN 'ofac' THEN raw_payload_json WHEN 'eia' THEN 'Fuel price data captured for logistics cost risk signals.' ELSE 'SEC filings metadata captured for sec_edgar_feed.' END,
  CAST(fetched AS DATE), r.api_run_id, CASE source_name WHEN 'ofac' THEN 'high' ELSE 'medium' END, 'US', NULL
FROM fx_payload_runs r JOIN fx_raw_all a ON a.api_run_id = r.api_run_id WHERE source_name IN ('ofac', 'eia', 'sec_edgar')
""")
_RULES = ("texts", "alias", "name", "country", "region", "category", "fuel", "scope_pairs", "best", "mart")
for _rule in _RULES:
    _own = re.sub(rf"\bmt_({'|'.join(_RULES)})\b", r"pm_\1", block(f"mt_{_rule}")).replace("fx_external_events", "pm_events")
    _own = _own.replace("THEN points END", "THEN CASE severity WHEN 'critical' THEN 20 WHEN 'high' THEN 12 WHEN 'medium' THEN 6 ELSE 2 END END")
    cte(f"pm_{_rule}", _own)


def payload_matched(t):
    """Landed payloads parsed, normalised and matched, with their evidence documents."""
    events, evidence = silver.split_evidence(E.normalize_events(SV._all_events(t)))
    return Matched(t, E.external_events(events)), evidence


@query("payload_mart", "M03 M35", """
SELECT source_name, risk_category, event_title, severity, strftime(event_date, '%Y-%m-%d') AS event_date, matched_supplier_id, match_type, match_value, match_confidence, group_supplier_count, matched_sku_count, CAST(score_contribution AS BIGINT) AS score_contribution,
  sha256(m.api_run_id || '||' || sha256(raw_payload_json)) AS evidence_doc_id FROM pm_mart m JOIN fx_raw_all a ON a.api_run_id = m.api_run_id
""")
def _(t):
    m, evidence = payload_matched(t)
    rows = M.event_mart(m.links, m.classes, sku_counts(t), evidence)
    return tidy(rows.select("source_name", "risk_category", "event_title", "severity", "event_date", "matched_supplier_id", "match_type", "match_value", "match_confidence", "group_supplier_count", "matched_sku_count", "score_contribution", "evidence_doc_id"))


@query("match_summary", "V13", "SELECT source_name, match_type, count(*) AS row_count, count(score_contribution) AS matched_count, rnd(avg(score_contribution), 4) AS avg_points FROM mt_mart GROUP BY 1, 2")
def _(t):
    return tidy(M.match_summary(mart(t)))


cte("mt_event_scores", """
SELECT supplier_id, least(100.0, coalesce(sum(points) FILTER (event_date >= DATE '2024-01-30' - 30), 0)) AS external_event_score, count(*) FILTER (event_date >= DATE '2024-01-30' - 30) AS active_event_count,
  count(*) FILTER (event_date >= DATE '2024-01-30' - 30 AND severity = 'critical') AS critical_event_count, CASE WHEN count(*) FILTER (source_name = 'ofac') > 0 THEN 80.0 ELSE 0.0 END AS sanctions_score,
  count(*) FILTER (source_name = 'ofac') AS ofac_match_count, least(100.0, 10.0 * count(*) FILTER (source_name = 'cisa' AND event_date >= DATE '2024-01-30' - 90)) AS cyber_score, count(*) FILTER (source_name = 'cisa' AND event_date >= DATE '2024-01-30' - 90) AS cisa_match_count
FROM mt_best JOIN fx_external_events USING (external_event_id) GROUP BY 1
""")


@query("event_scores", "R03 R05 R06", "SELECT supplier_id, rnd(external_event_score, 4) AS external_event_score, active_event_count, critical_event_count, rnd(sanctions_score, 4) AS sanctions_score, ofac_match_count, rnd(cyber_score, 4) AS cyber_score, cisa_match_count FROM mt_event_scores")
def _(t):
    return tidy(S.event_scores(*Matched(t).parts, I.EVENTS_AS_OF))


cte("mt_top_events", """
SELECT * FROM (SELECT supplier_id, external_event_id, source_name, event_title, severity, points, match_type, event_date, event_country, event_region, source_url,
  row_number() OVER (PARTITION BY supplier_id ORDER BY points DESC, external_event_id) AS r
FROM mt_best JOIN fx_external_events USING (external_event_id) WHERE event_date >= DATE '2024-01-30' - 30) WHERE r <= 3
""")


@query("top_supplier_events", "R12 W06", """
SELECT supplier_id, string_agg(source_name || ' · ' || event_title || ' · +' || points || ' pts', chr(10) ORDER BY r) AS top_events, string_agg(external_event_id, ',' ORDER BY r) AS evidence_ids, count(*) AS evidence_count FROM mt_top_events GROUP BY 1
""")
def _(t):
    top = S.top_supplier_events(*Matched(t).parts, I.EVENTS_AS_OF)
    return tidy(
        top.select("supplier_id", F.array_join("top_events_list", "\n").alias("top_events"), F.array_join("evidence_ids", ",").alias("evidence_ids"), "evidence_count")
    )


cte("mt_worst_events", "SELECT external_event_id FROM fx_external_events ORDER BY points DESC, event_date DESC, external_event_id LIMIT 20")


@query("event_suppliers", "M35 M34", "SELECT external_event_id, supplier_id, match_type, match_value, match_confidence FROM mt_best WHERE external_event_id IN (SELECT external_event_id FROM mt_worst_events)")
def _(t):
    """All suppliers of the 20 worst events, named or reached through a scope."""
    m = Matched(t)
    ranked = m.links.withColumn("points", severity_points(F.col("severity"))).orderBy(F.desc("points"), F.desc("event_date"), "external_event_id")
    rows = M.events_with_suppliers(cut_lineage(ranked.drop("event_summary").limit(20), "worst"), m.classes).filter("supplier_id IS NOT NULL")
    return tidy(rows.select("external_event_id", "supplier_id", *M.MATCH))


@query("supplier_events", "M35 M34", """
SELECT external_event_id, supplier_id, match_type, match_value, match_confidence FROM mt_best
WHERE supplier_id IN (SELECT supplier_id FROM fx_suppliers ORDER BY annual_spend DESC, supplier_id LIMIT 5)
""")
def _(t):
    """All events of the five suppliers with the largest spend."""
    m = Matched(t)
    largest = I.suppliers(t).orderBy(F.desc("annual_spend"), "supplier_id").limit(5)
    return tidy(M.expand_pairs(m.links, m.classes, suppliers=largest))
