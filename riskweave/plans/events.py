"""Raw payloads of seven sources parsed to one event shape."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.cleaning import record_id
from riskweave.functions.predicates import json_shape
from riskweave.functions.risk import common_severity, normalize_severity
from riskweave.operators.relational import top_k_per

EVENT_COLUMNS = (
    "source_name",
    "risk_category",
    "event_type",
    "event_timestamp",
    "event_date",
    "event_title",
    "event_summary",
    "source_url",
    "source_domain",
    "event_country",
    "event_region",
    "language",
    "severity",
    "evidence_type",
    "raw_payload_json",
    "payload_hash",
    "api_run_id",
)


@dataclass(frozen=True)
class Feed:
    """How one payload family maps to an event. ``items`` is the JSON path of the array inside
    the parsed payload ('' for a top-level array); ``fields`` are expressions over ``x``."""

    source: str
    risk_category: str
    evidence_type: str
    schema: str
    items: str
    key: str
    fields: dict[str, str]


# Payload layouts and field mappings of the item feeds.
ITEM_FEEDS = (
    Feed(
        "gdelt",
        "news_disruption",
        "article",
        "articles array<struct<url string, title string, seendate string, domain string, language string, sourcecountry string>>",
        "articles",
        "url",
        {
            "event_type": "'supply_chain_news'",
            "event_timestamp": "try_to_timestamp(x.seendate, \"yyyyMMdd'T'HHmmss'Z'\")",
            "event_title": "x.title",
            "event_summary": "x.title",
            "source_url": "x.url",
            "source_domain": "x.domain",
            "event_country": "x.sourcecountry",
            "language": "x.language",
            "severity": "'medium'",
        },
    ),
    Feed(
        "nws",
        "weather_logistics",
        "weather_alert",
        "features array<struct<id string, properties struct<event string, severity string, areaDesc string, headline string, description string, onset string, senderName string>>>",
        "features",
        "properties.event",
        {
            "event_type": "x.properties.event",
            "event_timestamp": "try_to_timestamp(x.properties.onset)",
            "event_title": "x.properties.headline",
            "event_summary": "x.properties.description",
            "source_url": "x.id",
            "source_domain": "x.properties.senderName",
            "event_country": "'US'",
            "event_region": "x.properties.areaDesc",
            "language": "'en'",
            "severity": "lower(x.properties.severity)",
        },
    ),
    Feed(
        "cisa",
        "cyber",
        "cyber_catalog",
        "vulnerabilities array<struct<cveID string, vulnerabilityName string, dateAdded string, shortDescription string, knownRansomwareCampaignUse string>>",
        "vulnerabilities",
        "cveID",
        {
            "event_type": "'known_exploited_vulnerability'",
            "event_timestamp": "try_to_timestamp(x.dateAdded)",
            "event_title": "concat_ws(' - ', x.cveID, x.vulnerabilityName)",
            "event_summary": "x.shortDescription",
            "source_url": "'https://www.cisa.gov/known-exploited-vulnerabilities-catalog'",
            "source_domain": "'cisa.gov'",
            "event_country": "'US'",
            "language": "'en'",
            "severity": "if(lower(x.knownRansomwareCampaignUse) = 'known', 'high', 'medium')",
        },
    ),
    Feed(
        "cpsc",
        "quality_recall",
        "product_recall",
        "array<struct<RecallNumber string, RecallDate string, Title string, Description string, URL string>>",
        "",
        "RecallNumber",
        {
            "event_type": "'product_recall'",
            "event_timestamp": "try_to_timestamp(x.RecallDate)",
            "event_title": "x.Title",
            "event_summary": "x.Description",
            "source_url": "x.URL",
            "source_domain": "'saferproducts.gov'",
            "event_country": "'US'",
            "language": "'en'",
            "severity": "'medium'",
        },
    ),
)

# One event per payload of the snapshot feeds.
SNAPSHOT_FEEDS = {
    "ofac": {
        "risk_category": "sanctions_compliance",
        "evidence_type": "sanctions_snapshot",
        "event_type": "endpoint_name",
        "event_title": "concat('OFAC sanctions file snapshot: ', endpoint_name)",
        "event_summary": "raw_payload_json",
        "source_domain": "'treasury.gov'",
        "severity": "'high'",
    },
    "sec_edgar": {
        "risk_category": "financial_filing",
        "evidence_type": "filing_metadata",
        "event_type": "'company_filings_snapshot'",
        "event_title": "concat('SEC company submissions snapshot: ', endpoint_name)",
        "event_summary": "concat('SEC filings metadata captured for ', endpoint_name, '.')",
        "source_domain": "'sec.gov'",
        "severity": "'medium'",
    },
    "eia": {
        "risk_category": "fuel_logistics_cost",
        "evidence_type": "fuel_price_snapshot",
        "event_type": "'fuel_price_snapshot'",
        "event_title": "'EIA fuel price data snapshot'",
        "event_summary": "'Fuel price data captured for logistics cost risk signals.'",
        "source_domain": "'eia.gov'",
        "severity": "'medium'",
    },
}


#: What a feed states of each event, with its type; the rest is copied from the payload.
_STATED = {c: "timestamp" if c == "event_timestamp" else "string" for c in EVENT_COLUMNS if c not in ("source_name", "event_date", "raw_payload_json", "payload_hash", "api_run_id")}


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{c}', CAST({fields.get(c, 'NULL')} AS {kind})" for c, kind in _STATED.items()) + ")"


def _items(f: Feed) -> str:
    """The events of one payload of an item feed as an array."""
    parsed = f"from_json(raw_payload_json, '{f.schema}')" + (f".{f.items}" if f.items else "")
    fields = {**f.fields, "risk_category": f"'{f.risk_category}'", "evidence_type": f"'{f.evidence_type}'"}
    return f"transform(filter({parsed}, x -> x.{f.key} IS NOT NULL), x -> {_struct(fields)})"


def _snapshot(spec: dict[str, str]) -> str:
    """The one event of a snapshot payload as an array."""
    named = {c: f"'{spec[c]}'" for c in ("risk_category", "evidence_type")}
    common = {"event_timestamp": "try_to_timestamp(fetched_at)", "source_url": "request_url", "event_country": "'US'", "language": "'en'"}
    return f"array({_struct({**common, **spec, **named})})"


def payload_events(raw: DataFrame, feeds: tuple[Feed, ...] = ITEM_FEEDS, snapshots: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Events of successful payloads in one scan: one row per item of an item feed that has its key
    field, one per payload of a snapshot source.

    Each payload is parsed by its own source's layout only, a branch of one expression that gives an array of
    the common event struct. Payloads of other sources, failed, empty or malformed ones give no row.
    """
    snapshots = SNAPSHOT_FEEDS if snapshots is None else snapshots
    branches = {f.source: _items(f) for f in feeds} | {s: _snapshot(spec) for s, spec in snapshots.items()}
    events = F.expr("CASE source_name " + " ".join(f"WHEN '{s}' THEN {e}" for s, e in branches.items()) + " END")
    kept = ("source_name", "raw_payload_json", "payload_hash", "api_run_id")
    # An outer explode: for a plain one Spark would add a test of the array's size, which parses again.
    rows = raw.filter(F.col("source_name").isin(*branches) & F.col("response_ok")).select(*kept, F.explode_outer(events).alias("e")).filter("e IS NOT NULL")
    own = {c: F.col(f"e.{c}") for c in _STATED} | {c: F.col(c) for c in kept} | {"event_date": F.to_date("e.event_timestamp")}
    return rows.select(*[own[c].alias(c) for c in EVENT_COLUMNS])


def parse_events(raw: DataFrame, feeds: tuple[Feed, ...] = ITEM_FEEDS) -> DataFrame:
    """One row per payload item; items without their key field are dropped."""
    return payload_events(raw, feeds, {})


def snapshot_events(raw: DataFrame, feeds: dict[str, dict[str, str]] = SNAPSHOT_FEEDS) -> DataFrame:
    """One row per successful payload of the snapshot sources."""
    return payload_events(raw, (), feeds)


def normalize_events(df: DataFrame) -> DataFrame:
    """Common words, fallbacks for missing texts, event id, and one row per id.

    The dedupe keeps the newest row; its order is total, so reruns give the same rows.
    """
    source = F.lower(F.trim("source_name"))
    category = F.lower(F.trim("risk_category"))
    fallback_title = F.concat(F.lit("External risk event from "), F.coalesce(F.col("source_name"), F.lit("unknown_source")))
    cleaned = (
        df.withColumns({"source_name": source, "risk_category": category})
        .withColumns(
            {
                "event_type": F.coalesce("event_type", F.concat(F.coalesce("risk_category", F.lit("unknown")), F.lit("_event"))),
                "severity": normalize_severity(F.col("severity")),
                "evidence_type": F.coalesce("evidence_type", F.lit("external_api_payload")),
                "event_title": F.coalesce("event_title", "event_summary", fallback_title),
            }
        )
        .withColumn("event_summary", F.coalesce("event_summary", "event_title"))
        .withColumn(
            "external_event_id",
            record_id("source_name", "risk_category", "event_type", "event_title", "source_url", "event_date", "payload_hash", "api_run_id"),
        )
    )
    order = [
        F.desc_nulls_last("event_timestamp"),
        F.desc_nulls_last("event_date"),
        F.asc_nulls_last("source_name"),
        F.asc_nulls_last("payload_hash"),
        F.asc_nulls_last("api_run_id"),
    ]
    return top_k_per(cleaned, ["external_event_id"], order, 1)


def external_events(normalized: DataFrame) -> DataFrame:
    """Normalised events in the shape that matching, mart and scores take: severity words on the one
    scale, the payload named as the source's."""
    return normalized.withColumn("severity", common_severity(F.col("severity"))).withColumnRenamed("payload_hash", "source_payload_hash")


def payload_shapes() -> dict[str, Column]:
    """Shape rule of each source's payload."""
    p = F.col("raw_payload_json")
    return {
        "gdelt": json_shape(p, paths=["$.articles"]),
        "nws": json_shape(p, paths=["$.features"], equals={"$.type": "FeatureCollection"}),
        "cisa": json_shape(p, paths=["$.vulnerabilities"]),
        "cpsc": json_shape(p, starts_with="["),
        "ofac": json_shape(p, paths=["$.rows"]),
        "sec_edgar": json_shape(p, paths=["$.rows"], keywords=["rows"]),
        "eia": json_shape(p, paths=["$.rows"], starts_with="{"),
    }
