import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskweave.operators.profiling import PII_SIGNALS, detect_pii
from riskweave.operators.relational import ranked_structs
from riskweave.plans import alerts as A
from riskweave.plans import context as C
from riskweave.plans import evidence as E
from riskweave.session import shared_folder
from riskweave.sources import tables as S

DAY = "2024-01-30"


def test_every_entity_over_the_cut_raises_an_alert(spark):
    sku = spark.range(200).selectExpr("concat('SKU_', id) AS canonical_sku_id", "'SUP_1' AS supplier_id", "0.7 + 0.001 * id AS stockout_probability")
    every = A.threshold_alerts(sku, A.SKU_ALERTS, DAY, "run")
    assert every.count() == sku.filter("stockout_probability >= 0.75").count() > 100
    worst = A.threshold_alerts(sku, A.SKU_ALERTS, DAY, "run", 3)
    assert sorted(r.sku_id for r in worst.collect()) == ["SKU_197", "SKU_198", "SKU_199"]


def test_rules_match_as_plain_conditions(spark):
    alerts = [(f"a{i}", t, c, s, k, r) for i, (t, c, s, k, r) in enumerate(
        (t, c, s, k, r) for t in ("x", "y", None) for c in ("p", "*") for s in ("S1", None) for k in ("K1", "K2") for r in (1, 3))]
    rules = [(f"r{i}", i, m, on, *v) for i, (m, on, *v) in enumerate(
        (m, on, t, c, s, k) for m in (1, 3) for on in (True, False) for t in ("x", "*", None) for c in ("p", "*") for s in ("S1", None) for k in ("K2", "*"))]
    a = spark.createDataFrame(alerts, "alert_id string, alert_type string, risk_category string, supplier_id string, sku_id string, severity_rank int")
    r = spark.createDataFrame(rules, "routing_rule_id string, rule_priority int, minimum_severity_rank int, is_active boolean, alert_type string, risk_category string, supplier_id string, sku_id string")
    r = r.selectExpr("*", "'g' AS recipient_group", "'e' AS recipient_email", "'email' AS channel", "false AS send_enabled", "1 AS escalation_minutes")
    fits = lambda rule, value: rule in (None, "*") or rule == value
    want = sorted((x[0], y[0]) for x in alerts for y in rules if y[3] and x[5] >= y[2] and all(fits(y[4 + d], x[1 + d]) for d in range(4)))
    got = A.match_rules(a, r).select("alert_id", "routing_rule_id")
    assert sorted(map(tuple, got.collect())) == want


def test_counts_reach_beyond_the_listed_rows(spark):
    df = spark.range(40).selectExpr("id % 2 AS k", "id AS v")
    got = {r.k: r for r in ranked_structs(df, ["k"], [F.desc("v")], 3, ["v"], "top", {"small": F.col("v") < 10}).collect()}
    assert got[0].top_count == 20 and got[0].small == 5 and [x.v for x in got[0].top] == [38, 36, 34]
    alerts = spark.range(25).selectExpr("concat('a', id) AS alert_id", "'t' AS alert_type", "CASE WHEN id < 15 THEN 'high' ELSE 'low' END AS severity", "'x' AS alert_title", "'new' AS alert_status", "'S1' AS supplier_id", "'2024' AS created_at")
    snap = C.open_alerts(alerts).first()
    assert (snap.open_alerts_count, snap.critical_or_high_alert_count, len(snap.open_alerts)) == (25, 15, 10)


def test_chunks_cover_whole_texts(spark):
    text = "".join(f"w{i} " for i in range(3000))
    df = spark.createDataFrame([("a", text), ("b", "short"), ("c", " \n "), ("d", None)], "chunk_id string, chunk_text string")
    got = E.clean_chunks(df, 100).collect()
    assert {r.original_chunk_id for r in got} == {"a", "b"}
    a = sorted((r.part, r.chunk_text_clean) for r in got if r.original_chunk_id == "a")
    assert len({r.chunk_id for r in got}) == len(got) and "".join(t for _, t in a).replace(" ", "") == text.replace(" ", "")


def chunk_rows(spark):
    vector = lambda i: None if i % 5 == 0 else [1.0, i / 100.0]
    data = [(f"c{i}", "S1" if i % 3 else None, "SK", "gdelt", "cyber", dt.date(2024, 1, 1), "high", 0.5, f"text {i}", vector(i)) for i in range(60)]
    return spark.createDataFrame(data, "chunk_id string, supplier_id string, sku_id string, source_name string, risk_category string, event_date date, severity string, freshness_weight double, chunk_text string, embedding array<double>")


def test_missing_vectors_take_no_part(spark):
    chunks = chunk_rows(spark)
    asked = spark.createDataFrame([("q1", "S1", None, None, 0, None, [1.0, 0.0]), ("q2", "S1", None, None, 0, None, None)],
                                  "query_id string, supplier_id string, sku_id string, risk_category string, window_days int, severities array<string>, query_embedding array<double>")
    best = E.retrieve(asked, chunks, DAY, 3).collect()
    assert sorted(r.chunk_id for r in best) == ["c1", "c2", "c3"]
    ranked = E.rerank(asked, chunks, DAY, 100).collect()
    assert len(ranked) == sum(1 for i in range(60) if i % 3 and i % 5)


def test_personal_data_names():
    assert detect_pii(["zip", "Customer Name", "Customer Segment", "email_1"]) == ["zip", "Customer Name", "email_1"]
    assert detect_pii(["customer_segment"], PII_SIGNALS) == ["customer_segment"]


def test_a_failing_query_leaves_the_table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS keepdb")
    S.create_table_as(spark, "SELECT 1 AS a", "keepdb.t")
    with pytest.raises(Exception, match="(?i)divi|zero|not_there"):
        S.create_table_as(spark, "SELECT not_there FROM keepdb.t", "keepdb.t")
    assert rows(spark.table("keepdb.t")) == [(1,)]
    S.create_table_as(spark, "SELECT a + 1 AS a FROM keepdb.t", "keepdb.t")
    assert rows(spark.table("keepdb.t")) == [(2,)]


def test_a_cluster_must_name_its_shared_folder(spark):
    class Elsewhere:
        conf = spark.conf
        sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "app"})()

    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(Elsewhere())
    assert shared_folder(spark) == shared_folder(spark)


def test_rules_of_any_set_of_dimensions_match(spark):
    alerts = spark.createDataFrame(
        [("a1", "x", "c", 3, "S1", None), ("a2", "x", None, 3, None, "K"), ("a3", "*", "c", 4, "S2", "K")],
        "alert_id string, alert_type string, risk_category string, severity_rank int, supplier_id string, sku_id string",
    )
    values = [(t, c, s, k) for t in ("x", "*", None) for c in ("c", "*") for s in ("S1", "S2", "*") for k in ("K", "*")]
    made = [(f"r{i}", i, t, c, 3, s, k) for i, (t, c, s, k) in enumerate(values)]
    rules = spark.createDataFrame(made, "routing_rule_id string, rule_priority int, alert_type string, risk_category string, minimum_severity_rank int, supplier_id string, sku_id string")
    full = rules.selectExpr("*", "'g' AS recipient_group", "1 AS escalation_minutes", "'e' AS recipient_email", "'m' AS channel", "true AS send_enabled", "true AS is_active")
    fits = lambda rule, own: rule in (None, "*") or rule == own
    want = sorted((a[0], r[0]) for a in [("a1", "x", "c", "S1", None), ("a2", "x", None, None, "K"), ("a3", "*", "c", "S2", "K")] for r in made if all(fits(v, o) for v, o in zip((r[2], r[3], r[5], r[6]), a[1:])))
    matched = A.match_rules(alerts, full)
    assert rows(matched.select("alert_id", "routing_rule_id")) == want
    asked = A.match_rules(alerts, full.filter("routing_rule_id = 'r23'"))  # 16 lookups of an alert before, one for one set
    assert "concat(array(*)" not in asked._jdf.queryExecution().optimizedPlan().toString()


def test_alerts_are_routed_where_they_lie(spark):
    made = spark.createDataFrame([("a1", "x", "c", "S1", None, 3, "new"), ("a2", "x", None, None, "K", 4, "new"), ("a3", "y", "c", "S2", "K", 1, "new"), ("a4", "x", "c", "S1", "K", None, "new")], "alert_id string, alert_type string, risk_category string, supplier_id string, sku_id string, severity_rank int, alert_status string")
    rule = lambda i, p, kind, sup, sku, to, on=True: (f"r{i}", p, kind, None, 2, f"team{to}", 5, sup, sku, f"t{to}@x", "email", False, on)
    rules = spark.createDataFrame([rule(1, 20, "*", None, "*", 1), rule(2, 10, "x", "S1", None, 1), rule(3, 10, "x", None, "K", 1), rule(4, 10, "x", "*", "K", 1), rule(5, 1, "x", "S1", "K", 2), rule(6, 1, "*", None, None, 2, False)], A.ROUTE_SCHEMA)
    routes = A.with_routes(made, rules)
    assert rows(A.route_alerts(routes).select("alert_id", "routing_rule_id")) == [("a1", "r2"), ("a2", "r3")]
    assert rows(A.route_alerts(routes)) == rows(A.route_alerts(made, rules))
    assert rows(A.mark_routed(routes)) == rows(A.mark_routed(made, A.route_alerts(made, rules)).select(*made.columns))
    for df in (A.route_alerts(routes), A.mark_routed(routes), A.match_rules(made, rules)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" not in plan  # alerts went through both before


def test_rows_that_stand_for_several_alerts_count_for_them(spark):
    alerts = spark.createDataFrame([("e", "high", "new", 5), ("e", "critical", "new", 2)], "alert_type string, severity string, alert_status string, alert_count long")
    assert ("alert_type", "e", 7) in rows(A.alert_breakdown(alerts))
    assert rows(A.alert_summary(alerts, ["alert_type"])) == [("e", 7)]


def test_alerts_with_keys_of_their_own_merge_as_all_others(spark):
    shape = "dedupe_key string, alert_id string, alert_status string, created_at string, severity string, severity_rank int, trigger_metric_value double, alert_message string, recommended_action string, alert_run_id string"
    row = lambda key, status, rank: (key, f"a{key}", status, status, "high", rank, float(rank), "m", "r", "run")
    known = spark.createDataFrame([row("x1", "seen", 1), row("e1", "seen", 1), row("e9", "seen", 1)], shape)
    new = spark.createDataFrame([row("x1", "new", 2), row("x1", "new", 3), row("x2", "new", 3)], shape)
    own = spark.createDataFrame([row("e1", "new", 4), row("e2", "new", 4)], shape)
    got = {r.dedupe_key: (r.alert_status, r.severity_rank) for r in A.merge_alerts(known, [new], own).collect()}
    assert got == {"x1": ("seen", 3), "x2": ("new", 3), "e1": ("seen", 4), "e2": ("new", 4), "e9": ("seen", 1)}
    assert rows(A.merge_alerts(known, [new], own)) == rows(A.merge_alerts(known, [new, own]))
    assert rows(A.merge_alerts(None, [new], own)) == rows(A.merge_alerts(None, [new, own]))


def test_alerts_beyond_the_list_are_counted(spark):
    alerts = spark.range(12).selectExpr("concat('a', id) AS alert_id", "'t' AS alert_type", "IF(id < 10, 'high', 'low') AS severity", "'x' AS alert_title", "'new' AS alert_status", "IF(id < 11, 'S1', 'S2') AS supplier_id", "'2024' AS created_at")
    more = spark.createDataFrame([("S1", 90), ("S3", 0)], "supplier_id string, unlisted_count long")
    got = {r.supplier_id: (r.open_alerts_count, r.critical_or_high_alert_count, len(r.open_alerts)) for r in C.open_alerts(alerts, 10, more).collect()}
    assert got == {"S1": (101, 100, 10), "S2": (1, 0, 1)}
