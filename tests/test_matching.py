"""Phrase matching and group-grain totals against brute force over all pairs."""

import itertools
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskweave.operators import matching as M
from riskweave.plans import scoring as S
from riskweave.session import cut_lineage

WORDS = "acme steel north port of the big ring co ltd x9".split()


def plain(text):
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).strip()


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(7)
    texts = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 30)))) for i in range(60)]
    texts += [(60, "ACME-Steel!! North"), (61, "steelacme"), (62, "")]
    phrases = sorted({" ".join(rnd.choice(WORDS) for _ in range(n)) for n in (1, 1, 2, 2, 3, 4, 5) for _ in range(6)} | {"AC", "Acme Steel", "of the big ring"})
    return texts, phrases


def test_phrases_equal_brute_force(spark, corpus):
    texts, phrases = corpus
    got = M.match_phrases(spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    want = {(i, p) for (i, t), p in itertools.product(texts, phrases) if plain(p) and f" {plain(p)} " in f" {plain(t)} "}
    assert {tuple(r) for r in got.collect()} == want


def test_substrings_equal_brute_force(spark, corpus):
    texts, phrases = corpus
    got = M.match_substrings(spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    want = {(i, p) for (i, t), p in itertools.product(texts, phrases) if p.lower() in t.lower()}
    assert {tuple(r) for r in got.collect()} == want


@pytest.fixture(scope="module")
def world(spark):
    """Small world with one source and one region holding a large share of the events."""
    rnd = random.Random(3)
    sup = [(f"S{i}", f"Maker{i} Works", f"C{i % 3}", ("ring", "bolt")[i % 2]) for i in range(9)]
    routes = [(f"R{i}", f"S{i % 9}", ("Asia", "Europe", "Asia Air")[i % 3], ("ocean", "truck", "air")[i % 3]) for i in range(14)]
    sources = ["nws"] * 4 + ["gdelt", "ofac", "cisa", "cpsc", "eia", "sec_edgar"]
    events = []
    for i in range(120):
        src = rnd.choice(sources)
        title = rnd.choice(["ring recall", "quiet day", f"maker{rnd.randint(0, 8)} works hit", "a bolt fell", f"code s{rnd.randint(0, 8)}"])
        region = rnd.choice(["asia", "asia coast", None, "EUROPE"]) if src in ("nws", "gdelt") else None
        events.append((f"e{i:03d}", src, "quality_recall", title, rnd.choice([title, None, "see maker1 works"]), rnd.choice(["extreme", "high", "medium", "odd"]), f"2024-01-{rnd.randint(1, 30):02d}", rnd.choice(["c0", "C1", None]), region))
    aliases = [(s[0], s[0].lower(), 0.6 if int(s[0][1]) % 2 else 0.9) for s in sup]
    frames = (
        spark.createDataFrame(events, "external_event_id string, source_name string, risk_category string, event_title string, event_summary string, severity string, event_date string, event_country string, event_region string").withColumn("event_date", F.to_date("event_date")),
        spark.createDataFrame(sup, "supplier_id string, supplier_name string, country string, supplier_category string"),
        spark.createDataFrame(routes, "route_id string, supplier_id string, risk_region string, transport_mode string"),
        spark.createDataFrame(aliases, "supplier_id string, alias_name string, match_confidence double"),
    )
    return frames, brute(events, sup, routes, aliases), events


def brute(events, sup, routes, aliases):
    best = {}

    def put(e, s, conf, kind, value):
        key = (-conf, kind, value)
        best[e, s] = min(best.get((e, s), key), key)

    for e in events:
        texts = [f" {plain(x)} " for x in (e[3], e[4]) if x]
        has = lambda p: any(f" {plain(p)} " in t for t in texts)
        for s, a, c in aliases:
            if has(a):
                put(e[0], s, c, "alias", a)
        for s in sup:
            if has(s[1]):
                put(e[0], s[0], 0.85, "name", s[1])
            if e[1] in M.COUNTRY_SOURCES and e[7] and e[7].lower() == s[2].lower():
                put(e[0], s[0], 0.65, "country", s[2].lower())
            if e[1] == "cpsc" and (has(s[3]) or e[2] in s[3]):
                put(e[0], s[0], 0.55, "category", s[3])
        for _, s, region, mode in routes:
            if e[1] in M.REGION_SOURCES and e[8] and (region.lower() in e[8].lower() or e[8].lower() in region.lower()):
                put(e[0], s, 0.60, "region", region.lower())
            if e[1] == "eia" and mode in M.FUEL_MODES:
                put(e[0], s, 0.50, "fuel_logistics", M.FUEL_SCOPE)
    return {k: (v[1], v[2], -v[0]) for k, v in best.items()}


def parts(world):
    events, sup, routes, aliases = world[0]
    return M.event_links(events, aliases, sup, routes), M.supplier_classes(M.supplier_scopes(sup, routes))


def test_expanded_pairs_equal_brute_force(world):
    links, classes = parts(world)
    got = {(r.external_event_id, r.supplier_id): (r.match_type, r.match_value, r.match_confidence) for r in M.expand_pairs(links, classes, events=links).collect()}
    assert got == world[1]


def test_supplier_totals_count_each_pair_once(world):
    links, classes = parts(world)
    got = {r.supplier_id: r.n for r in M.supplier_totals(links, classes, {"n": F.lit(1)}).collect()}
    want = {}
    for _, s in world[1]:
        want[s] = want.get(s, 0) + 1
    assert got == want


def test_top_events_equal_brute_force(world):
    links, classes = parts(world)
    scored = S.recent_points(links, "2024-01-30")
    top = M.top_events_per_supplier(scored, classes, S.event_order(), 3)
    got = {}
    for r in top.orderBy("supplier_id", "event_rank").collect():
        got.setdefault(r.supplier_id, []).append((r.external_event_id, r.match_type))
    points = {"extreme": 20, "high": 12, "medium": 6, "odd": 2}
    value = {e[0]: points[e[5]] for e in world[2]}
    want = {}
    for (e, s), m in world[1].items():
        want.setdefault(s, []).append((-value[e], e, m[0]))
    assert got == {s: [(e, m) for _, e, m in sorted(v)[:3]] for s, v in want.items()}


def test_event_mart_keeps_unmatched_events(spark, world):
    links, classes = parts(world)
    full = links.withColumns({c: F.lit(None).cast("string") for c in ("event_type", "source_url", "language", "event_timestamp", "api_run_id", "source_payload_hash")})
    skus = spark.createDataFrame([("S1", 4)], "supplier_id string, matched_sku_count int")
    evidence = spark.createDataFrame([], "api_run_id string, payload_hash string, evidence_document_id string")
    mart = M.event_mart(full, classes, skus, evidence)
    matched = {e for e, _ in world[1]}
    got = {r.external_event_id: r for r in mart.collect()}
    assert set(got) == {e[0] for e in world[2]}
    assert {e for e, r in got.items() if r.score_contribution is not None} == matched
    assert all(r.match_type == "none" for e, r in got.items() if e not in matched)
    assert rows(M.match_summary(mart))


def test_thousands_of_phrases_that_start_alike(spark):
    phrases = [f"the north steel ring number {i} of port" for i in range(3_000)] + ["the north steel"]
    texts = [(i, f"we saw the north steel ring number {i * 7} of port today, the north steel ring") for i in range(300)]
    got = M.match_phrases(spark.createDataFrame(texts, "text_id int, text string"), spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    want = {(i, f"the north steel ring number {i * 7} of port") for i in range(300)} | {(i, "the north steel") for i in range(300)}
    assert {tuple(r) for r in got.collect()} == want


def test_names_within(spark):
    names = spark.createDataFrame([("asia coast",), ("asia",), ("",), (None,)], "name string")
    parts = spark.createDataFrame([("asia",), ("coast",), ("x",), (None,)], "part string")
    assert {tuple(r) for r in M.names_within(names, parts).collect()} == {("asia coast", "asia"), ("asia coast", "coast"), ("asia", "asia")}


def test_pairs_need_a_selection(world):
    with pytest.raises(ValueError):
        M.expand_pairs(*parts(world))


def test_nothing_runs_while_plans_are_built(spark, world):
    spark.sparkContext.setJobGroup("building", "building")
    links, classes = parts(world)
    S.event_scores(links, classes, "2024-01-30")
    S.top_supplier_events(links, classes, "2024-01-30")
    M.events_with_suppliers(links, classes)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []


def test_events_with_suppliers_equal_brute_force(world):
    links, classes = parts(world)
    got = {(r.external_event_id, r.supplier_id): (r.match_type, r.match_value, r.match_confidence) for r in M.events_with_suppliers(links, classes).collect()}
    alone = {e[0] for e in world[2]} - {e for e, _ in world[1]}
    assert {k: v for k, v in got.items() if k[1] is not None} == world[1]
    assert {e for e, s in got if s is None} == alone


def test_counted_events_equal_pairs(spark, world):
    links, classes = parts(world)
    copies = links.unionByName(links.limit(30))  # equal rows count once; rows of one id that differ as their pairs do
    mixed = copies.unionByName(links.filter("external_event_id = 'e001'").withColumns({"scopes": F.expr("slice(scopes, 1, 0)"), "match_group_id": F.lit(None).cast("string")}))
    shown = mixed.select("external_event_id", "severity", "match_group_id", "scopes", "direct")
    want = rows(M.events_with_suppliers(shown, classes).groupBy("external_event_id").count())
    got = rows(M.events_with_counts(shown, classes).groupBy("external_event_id").agg(F.sum("alert_count").alias("count")))
    assert got == want
    assert M.events_with_counts(links.select(*shown.columns), classes).count() == links.count()


def test_filter_with_two_marks_stops_most_of_other_keys(spark):
    ids = lambda a, b: spark.range(a, b).select(F.xxhash64("id").alias("h"))
    passes = M.may_hold(ids(0, 300_000), F.col("h"), M.FILTER_LONGS, 2)
    assert ids(0, 20_000).filter(passes).count() == 20_000
    assert ids(1_000_000, 1_020_000).filter(passes).count() < 200  # about 1,380 with one bit in the smaller table


def written(world):
    links, classes = parts(world)
    return cut_lineage(links.drop("event_summary")), M.Classes(*[cut_lineage(x) for x in classes])


def test_first_pairs_by_digest_equal_all_pairs(spark, world):
    links, classes = written(world)
    mixed = links.unionByName(links.limit(30)).unionByName(
        links.filter("external_event_id = 'e001'").withColumns({"scopes": F.expr("slice(scopes, 1, 0)"), "match_group_id": F.lit(None).cast("string")})
    )
    shown = mixed.select("external_event_id", "severity", "match_group_id", "scopes", "direct")
    rank, ranks = F.length("external_event_id") - 2 + F.pmod(F.crc32("external_event_id"), F.lit(2)).cast("int"), (3, 2)
    digest = F.sha2(F.concat_ws("|", "external_event_id", "supplier_id"), 256)
    pairs = M.events_with_suppliers(shown, classes).filter("supplier_id IS NOT NULL").select("supplier_id", "external_event_id", rank.alias("r"), digest.alias("d")).collect()
    assert {p.r for p in pairs} == set(ranks)
    by = {s: [sum(p.supplier_id == s and p.r == r for p in pairs) for r in ranks] for s in {p.supplier_id for p in pairs}}
    counts = M.pairs_per_supplier(shown, classes, rank, ranks)
    assert {r.supplier_id: r.pairs for r in counts.collect()} == by and max(map(max, by.values())) > 8

    def first(k):
        return sorted((s, p.external_event_id) for s in by for p in sorted((p for p in pairs if p.supplier_id == s), key=lambda p: (-p.r, p.d))[:k])

    for k in (1, 4):
        got = M.first_pairs_by_digest(shown, classes, counts, rank, ranks, digest, k)
        assert sorted((r.supplier_id, r.external_event_id) for r in got.collect()) == first(k)
    some = M.first_pairs_by_digest(shown, classes, counts, rank, ranks, digest, 4, 2).collect()  # a bound may leave out the last, never the first
    found = {s: sorted((r.external_event_id for r in some if r.supplier_id == s)) for s in by}
    ranked = {s: [e for t, e in first(10**6) if t == s] for s in by}
    assert any(len(found[s]) < min(4, sum(by[s])) for s in by) and all(set(found[s]) <= set(ranked[s]) for s in by)


def test_pairs_are_not_shuffled(world):
    """Nothing but a projection and the union stands above the join that makes the pairs of a group."""
    plan = M.events_with_suppliers(*written(world))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = [line for line in plan if "Join Inner" in line and "array_contains" in line]
    assert len(made) == 1 and made[0].index("Join") < 12
