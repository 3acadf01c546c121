from riskweave.catalog import registry
from riskweave.catalog import silver as catalog
from riskweave.plans import events as E


def test_events_and_evidence_of_all_sources(spark, monkeypatch):
    bodies = {
        "gdelt": '{"articles":[{"url":"u","title":"t"}]}', "nws": '{"features":[{"id":"w","properties":{"event":"view","headline":"t"}}]}',
        "cisa": '{"vulnerabilities":[{"cveID":"CVE-1","vulnerabilityName":"t"}]}', "cpsc": '[{"RecallNumber":"R1","Title":"t"}]',
        "ofac": '{"rows":[]}', "eia": '{"rows":[]}', "sec_edgar": '{"rows":[]}',
    }
    rows = [(f"{s}_run_1", s, f"{s}_feed", "https://example.org/", True, "2024-01-01 00:00:00", b, f"h{s}") for s, b in bodies.items()]
    raw = spark.createDataFrame(
        rows, "api_run_id string, source_name string, endpoint_name string, request_url string, response_ok boolean, fetched_at string, raw_payload_json string, payload_hash string"
    )
    monkeypatch.setattr(catalog, "_raw", lambda t: raw)
    evidence = registry._QUERIES["split_evidence_all"].build(None).collect()
    events = registry._QUERIES["events_view_all"].build(None).collect()
    assert {r.api_run_id for r in evidence} == {r[0] for r in rows} and len(evidence) == 7
    assert {r.source_name for r in events} == set(bodies) and len(events) == 7
    named = {r.api_run_id: r.evidence_document_id for r in evidence}
    assert all(r.evidence_document_id == named[r.api_run_id] for r in events)


RAW = "api_run_id string, source_name string, endpoint_name string, request_url string, response_ok boolean, fetched_at string, raw_payload_json string, payload_hash string"


def payload(source, body, ok=True, run="r"):
    return (run, source, "feed", "https://example.org/", ok, "2024-01-01 00:00:00", body, "h")


def test_payloads_of_all_sources_are_read_in_one_scan(spark, tmp_path):
    rows = [payload("gdelt", '{"articles":[{"url":"u","title":"t"}]}'), payload("ofac", "{}")]
    spark.createDataFrame(rows, RAW).write.parquet(str(tmp_path / "raw"))
    events = E.normalize_events(E.payload_events(spark.read.parquet(str(tmp_path / "raw"))))
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Generate explode") == 1
    assert {r.source_name for r in events.collect()} == {"gdelt", "ofac"}


def test_odd_payloads_give_no_event(spark):
    item = '{"articles":[{"url":"u","title":"t"}]}'
    odd = [None, "", "{", "[]", "{}", '{"articles":null}', '{"articles":[]}', '{"articles":[{"title":"no key"}]}', '{"articles":[null]}', '{"articles":"x"}']
    rows = [payload("gdelt", b) for b in odd] + [payload("gdelt", item, ok=False), payload("gdelt", item, ok=None), payload("other", item), payload(None, item), payload("GDELT", item)]
    assert E.payload_events(spark.createDataFrame(rows, RAW)).count() == 0
    assert E.payload_events(spark.createDataFrame([], RAW)).count() == 0
    both = E.payload_events(spark.createDataFrame([payload("gdelt", '{"articles":[{"url":"a"},{"title":"x"},{"url":"b"}]}')] * 2, RAW))
    assert sorted(r.source_url for r in both.collect()) == ["a", "a", "b", "b"]
    assert sorted(r.source_url for r in E.normalize_events(both).collect()) == ["a", "b"]


def test_external_events_share_one_severity_scale(spark):
    words = ["Extreme", " severe", "Moderate", "minor", "n/a", None]
    body = lambda w: '{"features":[{"id":"w","properties":{"event":"e","severity":%s}}]}' % ("null" if w is None else f'"{w}"')
    raw = spark.createDataFrame([payload("nws", body(w), run=str(i)) for i, w in enumerate(words)], RAW)
    got = {r.api_run_id: r.severity for r in E.external_events(E.normalize_events(E.payload_events(raw))).collect()}
    assert [got[str(i)] for i in range(6)] == ["critical", "high", "medium", "low", "unknown", "unknown"]
