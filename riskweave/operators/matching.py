"""Matching of events to suppliers.

Text rules never pair every event with every phrase. A phrase is looked up by its rarest run of words
(or characters), which is an equi join, and only longer phrases are verified against the text. Rules
that apply to many suppliers (country, region, category, fuel) are kept at the grain of scope sets:
events with the same scopes are a group, suppliers with the same scopes a class. Totals are aggregated
per group and class before suppliers are joined. Event x supplier pairs of such rules are only
produced where a caller names the events or suppliers, with ``expand_pairs``. All is lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.risk import severity_points
from riskweave.functions.text import plain
from riskweave.operators.filters import may_hold
from riskweave.operators.relational import top_k_per, union_all

# Confidence of each rule, and the sources each group rule applies to.
NAME_CONFIDENCE = 0.85
SCOPE_CONFIDENCE = {"country": 0.65, "region": 0.60, "category": 0.55, "fuel_logistics": 0.50}
COUNTRY_SOURCES = ("nws", "gdelt", "ofac", "sec", "sec_edgar")
REGION_SOURCES = ("nws", "gdelt")
CATEGORY_SOURCES = ("cpsc",)
FUEL_SOURCES = ("eia",)
FUEL_MODES = ("ocean", "truck")
FUEL_SCOPE = "ocean_or_truck_route"



class Units(NamedTuple):
    """What texts and phrases are made of, and how many units a key has."""

    norm: Callable[[Column], Column]
    joiner: str
    run: int


#: Four megabytes: of a million keys, two bits each, one place in 300 passes by chance.
FILTER_LONGS = 1 << 19

WORDS = Units(plain, " ", 3)
CHARS = Units(F.lower, "", 4)


def match_phrases(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """Which phrases occur in which texts, on word boundaries.

    ``texts`` has (text_id, text); ``phrases`` has (phrase). Returns distinct (text_id, phrase).
    """
    return _occurrences(texts, phrases, WORDS)


def match_substrings(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """As ``match_phrases``, but any substring counts, ignoring case only."""
    return _occurrences(texts, phrases, CHARS)


def _names(size: int) -> list[str]:
    return [f"_u{k}" for k in range(1, size + 1)]


def _occurrences(texts: DataFrame, phrases: DataFrame, units: Units) -> DataFrame:
    """(text_id, phrase), with all other columns that ``phrases`` has, for each of its rows.

    A phrase of at most ``units.run`` units is its own key and needs no more than the equi join. A
    longer one is keyed by that of its runs which stands in the fewest texts, and is then
    verified against the whole text. Places that no phrase can need are stopped by a filter of keys
    before any shuffle.

    The narrow texts are dealt anew by id first, so that the work on their many runs is even however the
    files were split; the branches of the plan share that exchange. What follows keeps that dealing, so
    the places that pass the filter are shuffled once, to meet the keys.
    """
    names, run = _names(units.run), units.run
    as_key = F.concat_ws(units.joiner, *names)
    parts = phrases.select("phrase").distinct().select("phrase", units.norm(F.col("phrase")).alias("_n")).filter(F.col("_n") != "")
    parts = parts.select("phrase", "_n", F.split("_n", units.joiner).alias("_u")).withColumn("_more", F.size("_u") - run)
    starts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("_more"))), lambda i: F.struct(*[F.get("_u", i + k).alias(c) for k, c in enumerate(names)])
    )
    runs = parts.select("phrase", "_n", "_more", F.inline(F.array_distinct(starts)))  # a short phrase has one
    wanted = runs.select(F.xxhash64(*names).alias("h"))

    # no filter on the normal text: it would be computed before the exchange, by the few tasks of the scan, and a
    # text that may be null would get one in some branches, which then could not share the exchange
    dealt = texts.select("text_id", F.coalesce("text", F.lit("")).alias("text")).filter("text_id IS NOT NULL").repartition("text_id")
    normal = dealt.select("text_id", units.norm(F.col("text")).alias("_t"))
    split = normal.select("text_id", F.split("_t", units.joiner).alias("_u"))
    leads = [F.slice("_u", k, F.size("_u")) for k in range(2, run + 1)]
    places = split.select("text_id", F.inline(F.arrays_zip("_u", *leads))).toDF("text_id", *names)
    sized = places.select("text_id", *names, F.explode(F.array(*[F.lit(k) for k in range(1, run + 1)])).alias("_size"))
    # units beyond the size are null, which leaves a hash as it is, so a shorter run hashes as itself
    cut = [F.when(F.col("_size") >= k, F.col(c)).alias(c) for k, c in enumerate(names, 1)]
    real = reduce(lambda a, b: a & b, [(F.col("_size") < k) | F.col(c).isNotNull() for k, c in enumerate(names, 1)])
    met = sized.filter(real).select("text_id", "_size", *cut).filter(may_hold(wanted, F.xxhash64(*names), FILTER_LONGS, 2))
    hits = met.select("text_id", as_key.alias("_key"), "_size").distinct()

    seen = hits.filter(F.col("_size") == run).groupBy("_key").agg(F.count(F.lit(1)).alias("_seen"))
    longer = runs.filter("_more > 0").select("phrase", "_n", as_key.alias("_key")).join(seen, "_key", "left")
    # a phrase with a run that no text has cannot occur
    rarest = longer.groupBy("phrase", "_n").agg(
        F.min_by("_key", F.struct("_seen", "_key")).alias("_key"), F.bool_and(F.col("_seen").isNotNull()).alias("_all")
    )
    short = runs.filter("_more <= 0").select("phrase", F.lit(None).cast("string").alias("_n"), as_key.alias("_key"), (F.col("_more") + run).alias("_size"))
    keys = short.unionByName(rarest.filter("_all").select("phrase", "_n", "_key", F.lit(run).alias("_size")))

    more = [c for c in phrases.columns if c != "phrase"]
    keys = keys.join(phrases, "phrase") if more else keys
    found = hits.join(keys, ["_key", "_size"]).select("text_id", "phrase", "_n", *more)
    edged = lambda c: F.concat(F.lit(units.joiner), F.col(c), F.lit(units.joiner))
    checked = found.filter("_n IS NOT NULL").join(normal, "text_id").filter(edged("_t").contains(edged("_n")))
    return found.filter("_n IS NULL").select("text_id", "phrase", *more).unionByName(checked.select("text_id", "phrase", *more))


def event_texts(events: DataFrame) -> DataFrame:
    """Title and summary of each event as separate texts, so no phrase spans both."""
    parts = F.array_distinct(F.filter(F.array("event_title", "event_summary"), lambda x: x.isNotNull()))
    return events.select("external_event_id", F.posexplode(parts).alias("_part", "text")).withColumn(
        "text_id", F.struct("external_event_id", "_part")
    )


def phrase_hits(events: DataFrame, phrases: DataFrame, mode: str = "word") -> DataFrame:
    """Distinct (external_event_id, phrase) for any dictionary of phrases."""
    match = {"word": match_phrases, "substring": match_substrings}[mode]
    hits = match(event_texts(events).select("text_id", "text"), phrases)
    return hits.select(F.col("text_id.external_event_id").alias("external_event_id"), "phrase").distinct()


def alias_phrases(aliases: DataFrame) -> DataFrame:
    return aliases.select(
        F.col("alias_name").alias("phrase"),
        F.lit("alias").alias("match_type"),
        "supplier_id",
        F.col("alias_name").alias("match_value"),
        "match_confidence",
    )


def name_phrases(suppliers: DataFrame) -> DataFrame:
    """Full name and, where it differs, its first two words."""
    short = F.array_join(F.slice(F.split("supplier_name", " "), 1, 2), " ")
    return suppliers.select(
        F.explode(F.array_distinct(F.array(F.col("supplier_name"), short))).alias("phrase"),
        F.lit("name").alias("match_type"),
        "supplier_id",
        F.col("supplier_name").alias("match_value"),
        F.lit(NAME_CONFIDENCE).alias("match_confidence"),
    )


def category_phrases(suppliers: DataFrame) -> DataFrame:
    return suppliers.select(F.lower("supplier_category").alias("phrase")).filter("phrase IS NOT NULL").distinct()


def resolve_hits(hits: DataFrame, phrases: DataFrame) -> DataFrame:
    """Phrase hits turned into event x supplier matches."""
    return hits.join(phrases, "phrase").select(
        "external_event_id", "supplier_id", "match_type", "match_value", "match_confidence"
    ).distinct()


def match_alias(events: DataFrame, aliases: DataFrame, mode: str = "word") -> DataFrame:
    """Events that mention an alias; the confidence is the alias's own."""
    phrases = alias_phrases(aliases)
    return resolve_hits(phrase_hits(events, phrases, mode), phrases)


def match_name(events: DataFrame, suppliers: DataFrame, mode: str = "word") -> DataFrame:
    """Events that mention a supplier's name or its first two words."""
    phrases = name_phrases(suppliers)
    return resolve_hits(phrase_hits(events, phrases, mode), phrases)


def best_order() -> list[Column]:
    return [F.desc("match_confidence"), F.asc("match_type"), F.asc("match_value")]


def best_matches(*matches: DataFrame) -> DataFrame:
    """Highest confidence per event and supplier over all rules."""
    return top_k_per(union_all(list(matches)), ["external_event_id", "supplier_id"], best_order(), 1)


def _scope(df: DataFrame, key: str, kind: str, value: Column) -> DataFrame:
    return df.select(key, F.lit(kind).alias("scope_type"), value.alias("scope_value"))


def supplier_scopes(suppliers: DataFrame, routes: DataFrame) -> DataFrame:
    """The groups each supplier belongs to."""
    return union_all(
        [
            _scope(suppliers, "supplier_id", "country", F.lower("country")),
            _scope(suppliers, "supplier_id", "category", F.lower("supplier_category")),
            _scope(routes, "supplier_id", "region", F.lower("risk_region")),
            _scope(
                routes.filter(F.col("transport_mode").isin(*FUEL_MODES)),
                "supplier_id",
                "fuel_logistics",
                F.lit(FUEL_SCOPE),
            ),
        ]
    ).filter(F.col("scope_value").isNotNull()).distinct()


def _country_scope() -> Column:
    hit = F.lower("source_name").isin(*COUNTRY_SOURCES)
    return F.when(hit & F.col("event_country").isNotNull(), _scope_struct("country", F.lower("event_country")))


def _fuel_scope() -> Column:
    return F.when(F.lower("source_name").isin(*FUEL_SOURCES), _scope_struct("fuel_logistics", F.lit(FUEL_SCOPE)))


def _scope_struct(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("scope_type"), value.alias("scope_value"))


def _exploded(events: DataFrame, scopes: list[Column]) -> DataFrame:
    present = F.filter(F.array(*scopes), lambda s: s.isNotNull())
    return events.select("external_event_id", F.explode(present).alias("s")).select("external_event_id", "s.*")


def match_country(events: DataFrame) -> DataFrame:
    return _exploded(events, [_country_scope()])


def match_fuel(events: DataFrame) -> DataFrame:
    return _exploded(events, [_fuel_scope()])


def event_names(events: DataFrame) -> DataFrame:
    """Distinct source, region and risk category names: a small table at any number of events."""
    return events.select(
        F.lower("source_name").alias("source"), F.lower("event_region").alias("region"), F.lower("risk_category").alias("risk")
    ).distinct()


def _substrings(name: Column) -> Column:
    """All substrings of a short name."""
    length = F.length(name)
    starts = F.sequence(F.lit(1), length)
    return F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), length - i + 1), lambda n: F.substr(name, i, n))))


def names_within(names: DataFrame, parts: DataFrame) -> DataFrame:
    """(name, part): which of the distinct ``parts`` are substrings of which distinct ``names``. For
    dictionaries of short names: every substring of a name is looked up, an equi join."""
    known = names.select("name").filter(F.length("name") > 0).distinct()
    looked_up = known.select("name", F.explode(F.array_distinct(_substrings(F.col("name")))).alias("part"))
    return looked_up.join(parts.select("part").distinct(), "part").select("name", "part")


def region_pairs(names: DataFrame, routes: DataFrame) -> DataFrame:
    """Event region names with the route regions they overlap: either text holds the other.
    Decided once per distinct pair of names, so it does not grow with events or routes."""
    ours = routes.select(F.lower("risk_region").alias("name")).distinct()
    theirs = names.filter(F.col("source").isin(*REGION_SOURCES)).select(F.col("region").alias("name")).distinct()
    in_event = names_within(theirs, ours.withColumnRenamed("name", "part")).toDF("_event", "_route")
    in_route = names_within(ours, theirs.withColumnRenamed("name", "part")).toDF("_route", "_event")
    return in_event.unionByName(in_route).distinct()


def match_region(events: DataFrame, routes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    hit = events.filter(F.lower("source_name").isin(*REGION_SOURCES))
    pairs = region_pairs(names if names is not None else event_names(events), routes)
    return _scope(hit.join(pairs, F.lower(hit.event_region) == pairs._event), "external_event_id", "region", F.col("_route"))


def risk_pairs(names: DataFrame, categories: DataFrame) -> DataFrame:
    """Risk categories of recalls with the supplier categories they are part of (distinct names only)."""
    risks = names.filter(F.col("source").isin(*CATEGORY_SOURCES)).select(F.col("risk").alias("part"))
    return names_within(categories.withColumnRenamed("phrase", "name"), risks).toDF("_category", "_risk")


def match_category(events: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Recalls whose text names a supplier category, or whose risk category is part of one."""
    categories = category_phrases(suppliers)
    recalls = events.filter(F.lower("source_name").isin(*CATEGORY_SOURCES))
    by_text = _scope(phrase_hits(recalls, categories), "external_event_id", "category", F.col("phrase"))
    pairs = risk_pairs(event_names(events), categories)
    by_risk = recalls.join(pairs, F.lower(recalls.risk_category) == pairs._risk)
    return by_text.unionByName(_scope(by_risk, "external_event_id", "category", F.col("_category"))).distinct()


def match_texts(events: DataFrame, aliases: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Best alias or name match per event and supplier from one pass over the event texts."""
    phrases = alias_phrases(aliases).unionByName(name_phrases(suppliers))
    return best_matches(resolve_hits(phrase_hits(events, phrases), phrases))


def event_links(events: DataFrame, aliases: DataFrame, suppliers: DataFrame, routes: DataFrame) -> DataFrame:
    """Events with all that links them to suppliers, one row each.

    ``direct`` lists the suppliers named in the texts with their best match; ``scopes`` the countries,
    regions, categories and fuel rule that apply, sorted; events with the same scopes share a
    ``match_group_id``. Both lists are short: an event names few suppliers and has few scopes.
    """
    none = F.lit(None).cast("string")
    phrases = alias_phrases(aliases).unionByName(name_phrases(suppliers)).withColumn("scope_value", none)
    categories = category_phrases(suppliers).select(
        "phrase", none.alias("match_type"), none.alias("supplier_id"), none.alias("match_value"), F.lit(None).cast("double").alias("match_confidence"), F.col("phrase").alias("scope_value")
    )
    named = phrases.unionByName(categories)
    best = F.min(F.struct((-F.col("match_confidence")).alias("c"), "match_type", "match_value")).alias("_b")
    # events are known by a digest here, a quarter of an id's size; both groupings use the one exchange by event
    digest = F.unhex(F.md5(F.col("external_event_id").cast("binary")))
    narrow = events.select(digest.alias("external_event_id"), "event_title", "event_summary").filter("external_event_id IS NOT NULL")
    texts = event_texts(narrow)
    hits = _occurrences(texts.select("text_id", "text"), named, WORDS).select("*", F.col("text_id.external_event_id").alias("_event"))
    found = hits.drop("text_id", "phrase").repartition("_event").groupBy("_event", "supplier_id", "scope_value").agg(best)
    match = F.struct("supplier_id", F.col("_b.match_type").alias("match_type"), F.col("_b.match_value").alias("match_value"), (-F.col("_b.c")).alias("match_confidence"))
    per_event = found.groupBy("_event").agg(
        F.collect_list(F.when(F.col("supplier_id").isNotNull(), match)).alias("direct"), F.collect_set("scope_value").alias("_named")
    )

    names = event_names(events)
    regions = region_pairs(names, routes).groupBy(F.col("_event").alias("_region")).agg(F.collect_set("_route").alias("_regions"))
    risks = risk_pairs(names, category_phrases(suppliers)).groupBy("_risk").agg(F.collect_set("_category").alias("_risks"))
    source = F.lower("source_name")
    empty = F.array().cast("array<string>")
    of_source = lambda kind, sources, values: F.transform(
        F.when(source.isin(*sources), values).otherwise(empty), lambda v: _scope_struct(kind, v)
    )
    scopes = F.concat(
        F.array_compact(F.array(_country_scope(), _fuel_scope())),
        of_source("region", REGION_SOURCES, F.coalesce("_regions", empty)),
        of_source("category", CATEGORY_SOURCES, F.array_union(F.coalesce("_named", empty), F.coalesce("_risks", empty))),
    )
    no_match = F.array().cast("array<struct<supplier_id:string,match_type:string,match_value:string,match_confidence:double>>")
    return (
        events.join(F.broadcast(regions), F.lower("event_region") == F.col("_region"), "left")
        .join(F.broadcast(risks), F.lower("risk_category") == F.col("_risk"), "left")
        .join(per_event, digest == F.col("_event"), "left")
        .select(*[events[c] for c in events.columns], F.coalesce("direct", no_match).alias("direct"), F.array_sort(F.array_distinct(scopes)).alias("scopes"))
        .withColumn("match_group_id", F.when(F.size("scopes") > 0, F.sha2(F.to_json("scopes"), 256)))
    )


def scope_confidence(scope_type: Column) -> Column:
    out = None
    for kind, value in SCOPE_CONFIDENCE.items():
        hit = scope_type == kind
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def best_scope(scopes: Column) -> Column:
    """The most confident scope of a list as (negative confidence c, t, v); null for an empty one."""
    keyed = F.transform(
        scopes,
        lambda s: F.struct((-scope_confidence(s["scope_type"])).alias("c"), s["scope_type"].alias("t"), s["scope_value"].alias("v")),
    )
    return F.array_min(keyed)


class Classes(NamedTuple):
    """Suppliers that share all their scopes are one class."""

    suppliers: DataFrame  # supplier_id, class_id, own (their scopes)
    scopes: DataFrame  # class_id, class_size, own, scope_type, scope_value


def supplier_classes(memberships: DataFrame) -> Classes:
    """A supplier has few scopes, so its collected set is small however many suppliers there are."""
    signed = (
        memberships.groupBy("supplier_id")
        .agg(F.array_sort(F.collect_set(F.struct("scope_type", "scope_value"))).alias("own"))
        .withColumn("class_id", F.sha2(F.to_json("own"), 256))
    )
    sized = signed.groupBy("class_id").agg(F.first("own").alias("own"), F.count(F.lit(1)).alias("class_size"))
    return Classes(signed.select("supplier_id", "class_id", "own"), sized.select("*", F.inline("own")))


MATCH = ("match_type", "match_value", "match_confidence")


def _matched_by(best: Column) -> list[Column]:
    return [best["t"].alias("match_type"), best["v"].alias("match_value"), (-best["c"]).alias("match_confidence")]


def _with_classes(rows: DataFrame, keys: list[str], classes: Classes) -> DataFrame:
    """``rows`` with ``scopes``, each with every class it shares a scope with, through the best of them.

    Rows are groups, or few events of a group; groups and classes are distinct scope sets, whose number
    follows the dictionaries (countries, regions, categories), not events or suppliers.
    """
    met = rows.select("*", F.inline("scopes")).join(classes.scopes, ["scope_type", "scope_value"]).drop("scope_type", "scope_value")
    return met.dropDuplicates([*keys, "class_id"]).withColumn("_b", best_scope(F.array_intersect("scopes", "own")))


#: Kind of the scope that stands for a supplier named in a text.
NAMED = "named"


def _reached(rows: DataFrame, keys: list[str], classes: Classes) -> DataFrame:
    """``rows`` with who they reach: ``who`` is a class, by a shared scope, or the supplier ``named``.

    Both ways go through one join, so that ``rows``, the costly side, stand in the plan once. ``_b`` is
    the best scope that the row and the class or supplier share, null if there is none.
    """
    of_name = F.array(_scope_struct(NAMED, F.col("named")))
    asked = rows.select("*", F.inline(F.when(F.col("named").isNull(), F.col("scopes")).otherwise(of_name)))
    shared = classes.scopes.select("scope_type", "scope_value", F.col("class_id").alias("who"), "own")
    single = classes.suppliers.select(F.lit(NAMED).alias("scope_type"), F.col("supplier_id").alias("scope_value"), F.col("supplier_id").alias("who"), "own")
    known = shared.unionByName(single)
    met = asked.join(known, ["scope_type", "scope_value"], "left").withColumn("who", F.coalesce("who", "named"))
    once = met.filter("who IS NOT NULL").drop("scope_type", "scope_value").dropDuplicates([*keys, "who"])
    return once.withColumn("_b", best_scope(F.array_intersect("scopes", "own"))).drop("own")


def _members(classes: Classes) -> DataFrame:
    """Suppliers of each class, and every supplier of itself."""
    own = classes.suppliers.select(F.col("supplier_id").alias("who"), "supplier_id")
    return classes.suppliers.select(F.col("class_id").alias("who"), "supplier_id").unionByName(own)


def _to_suppliers(reached: DataFrame, classes: Classes) -> DataFrame:
    """``supplier_id`` in place of ``who``; a supplier without any scope is in no class and keeps its name."""
    joined = reached.join(_members(classes), "who", "left")
    return joined.withColumn("supplier_id", F.coalesce("supplier_id", "named")).drop("who", "named").filter("supplier_id IS NOT NULL")


def group_classes(links: DataFrame, classes: Classes) -> DataFrame:
    """Which groups reach which classes, and how."""
    groups = links.filter("match_group_id IS NOT NULL").groupBy("match_group_id").agg(F.first("scopes").alias("scopes"))
    return _with_classes(groups, ["match_group_id"], classes).select("match_group_id", "class_id", "class_size", *_matched_by(F.col("_b")))


def suppliers_of_groups(links: DataFrame, classes: Classes) -> DataFrame:
    """The suppliers of each group, with the scope that reaches them."""
    return group_classes(links, classes).join(classes.suppliers, "class_id").select("match_group_id", "supplier_id", *MATCH)


def direct_pairs(links: DataFrame, classes: Classes, outer: bool = False, keep_scope: bool = False) -> DataFrame:
    """A row per event and supplier named in its texts, with the columns of ``links``; with ``outer`` also
    one row without supplier per event that names none. Where a scope of both is more confident than
    the name, the match is that scope. ``keep_scope`` adds ``_shared``, whether both share one."""
    named = links.select(*[c for c in links.columns if c != "direct"], (F.inline_outer if outer else F.inline)("direct"))
    best = best_scope(F.array_intersect("scopes", "own"))
    known = named.join(classes.suppliers.drop("class_id"), "supplier_id", "left").withColumn("_b", best)
    scope_wins = F.coalesce(-F.col("_b.c") > F.col("match_confidence"), F.lit(False))
    by_scope = _matched_by(F.col("_b"))
    if keep_scope:
        known = known.withColumn("_shared", F.col("_b").isNotNull())
    return known.withColumns({m: F.when(scope_wins, by_scope[i]).otherwise(F.col(m)) for i, m in enumerate(MATCH)}).drop("_b", "own")


def expand_pairs(links: DataFrame, classes: Classes, events: DataFrame | None = None, suppliers: DataFrame | None = None) -> DataFrame:
    """Event x supplier pairs with their best match, for the events (external_event_id) or the suppliers
    (supplier_id) of a selection. Over all of both it would be as large as events times suppliers, so
    one selection is required; it is applied before any pair is made.
    """
    if events is None and suppliers is None:
        raise ValueError("name the events or the suppliers whose pairs are wanted")
    if events is not None:
        links = links.join(events.select("external_event_id").distinct(), "external_event_id", "left_semi")
    direct = direct_pairs(links, classes).select("external_event_id", "supplier_id", *MATCH)
    if suppliers is not None:
        wanted = suppliers.select("supplier_id").distinct()
        direct = direct.join(wanted, "supplier_id", "left_semi")
        classes = Classes(classes.suppliers.join(wanted, "supplier_id", "left_semi"), classes.scopes)
    through_group = links.select("external_event_id", "match_group_id").join(suppliers_of_groups(links, classes), "match_group_id")
    return best_matches(direct, through_group.drop("match_group_id"))


def _each_way(links: DataFrame) -> DataFrame:
    """Every event once for its scopes, where ``named`` is null, and once for each supplier it names."""
    nobody = F.lit(None).cast("struct<supplier_id:string,match_type:string,match_value:string,match_confidence:double>")
    ways = F.explode(F.concat(F.array(nobody), "direct")).alias("_d")
    return links.select(*[c for c in links.columns if c != "direct"], ways).select("*", F.col("_d.supplier_id").alias("named"))


def _match_of(rows: DataFrame) -> DataFrame:
    """The match columns from the named match ``_d`` or, where it is more confident, the shared scope."""
    name, scope = [F.col(f"_d.{m}") for m in MATCH], _matched_by(F.col("_b"))
    scope_wins = F.col("named").isNull() | F.coalesce(-F.col("_b.c") > name[2], F.lit(False))
    return rows.withColumns({m: F.when(scope_wins, scope[i]).otherwise(name[i]) for i, m in enumerate(MATCH)}).drop("_d", "_b")


#: Tasks that share the suppliers of one group where pairs are made.
DEALT = 8


def _by_id(chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the links whose id is theirs alone, and rows that share an id but differ."""
    once = chosen.distinct().withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("external_event_id")))
    return once.filter("_n = 1").drop("_n"), once.filter("_n > 1").drop("_n")


def _through_groups(events: DataFrame, reached: DataFrame, wanted: Column) -> DataFrame:
    """The ``wanted`` pairs of events and the suppliers that ``reached`` gives for their groups. The two sides
    are shuffled by group, the suppliers of a group dealt over tasks; the pairs are not."""
    dealt = reached.withColumn("_deal", F.pmod(F.xxhash64("supplier_id"), F.lit(DEALT)).cast("int"))
    copies = events.filter("match_group_id IS NOT NULL").withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    return copies.join(dealt, ["match_group_id", "_deal"]).filter(wanted).drop("_deal")


def _ranked_pairs(chosen: DataFrame, classes: Classes) -> DataFrame:
    """``events_with_suppliers`` for rows that may share an id: the best match of all of them decides."""
    direct = direct_pairs(chosen, classes, outer=True).drop("scopes")
    by_scope = _with_classes(chosen.drop("direct"), ["external_event_id"], classes).drop("own", "scopes")
    through = by_scope.join(classes.suppliers.drop("own"), "class_id").select("*", *_matched_by(F.col("_b")))
    pairs = direct.unionByName(through.select(*direct.columns))
    best = top_k_per(pairs, ["external_event_id", "supplier_id"], best_order(), 1)
    matched = F.max(F.col("supplier_id").isNotNull()).over(Window.partitionBy("external_event_id"))
    return best.withColumn("_m", matched).filter("supplier_id IS NOT NULL OR NOT _m").drop("_m")


def events_with_suppliers(chosen: DataFrame, classes: Classes) -> DataFrame:
    """A row per event of ``chosen``, rows of the links, and supplier it matches directly or by scope,
    with the best match; an event without any supplier keeps one row. As large as the pairs of the
    chosen events, so choose first, as by severity; ``chosen`` is read several times.

    Pairs are made where they are used and never shuffled: a supplier named in an event's texts is left
    out of those that its group reaches. Only rows that share an id but differ have their pairs ranked.
    """
    one, several = _by_id(chosen)
    reached = suppliers_of_groups(one, classes)
    direct = direct_pairs(one, classes).drop("scopes")
    unnamed = ~F.array_contains(F.col("direct.supplier_id"), F.col("supplier_id"))
    through = _through_groups(one.drop("scopes"), reached, unnamed).drop("direct")
    groups = group_classes(one, classes).select("match_group_id").distinct()
    alone = one.filter(F.size("direct") == 0).drop("direct", "scopes").join(F.broadcast(groups), "match_group_id", "left_anti")
    parts = [direct, through, alone, _ranked_pairs(several, classes)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pairs_per_supplier(chosen: DataFrame, classes: Classes, rank: Column, ranks: tuple[int, ...]) -> DataFrame:
    """``supplier_id`` and ``pairs``, how many pairs it has in ``chosen`` by ``rank``, in the order of
    ``ranks``; counted through groups and classes."""
    one, several = _by_id(chosen)
    measures = {f"_n{r}": (rank == r).cast("long") for r in ranks}
    pairs = _ranked_pairs(several, classes).filter("supplier_id IS NOT NULL")
    more = pairs.groupBy("supplier_id").agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    every = supplier_totals(one, classes, measures).unionByName(more)
    sums = every.groupBy("supplier_id").agg(*[F.sum(n).alias(n) for n in measures])
    return sums.select("supplier_id", F.array(*measures).alias("pairs"))


def first_pairs_by_digest(
    chosen: DataFrame, classes: Classes, counts: DataFrame, rank: Column, ranks: tuple[int, ...], digest: Column, k: int, spare: int | None = None
) -> DataFrame:
    """(external_event_id, supplier_id, pair_rank) of the first ``k`` pairs of each supplier, by ``rank``, in the
    order of ``ranks``, then by ``digest``, a hexadecimal digest of the two ids. ``counts`` has the pairs
    of each supplier, as ``pairs_per_supplier`` gives them; suppliers it does not hold are left out.

    Such an order knows no first pairs of a group, so every pair is looked at, but only of the ranks that can
    be among a supplier's first; and where a supplier has many, only digests below a bound are kept, so
    that about ``spare`` of each rank leave the task that makes them. With ``spare`` a supplier may by chance be
    left with less than ``k``; ask for those again without, which keeps all.
    """
    one, several = _by_id(chosen)
    shown = ["external_event_id", "supplier_id", "pair_rank", "_digest"]
    shaped = lambda df: df.withColumns({"pair_rank": rank, "_digest": digest}).select(*shown)
    asked = counts.select("supplier_id")
    few = direct_pairs(one, classes, keep_scope=True).filter("NOT _shared").join(asked, "supplier_id", "left_semi")
    found = [shaped(few), shaped(_ranked_pairs(several, classes).join(asked, "supplier_id", "left_semi"))]
    reached = suppliers_of_groups(one, classes).select("match_group_id", "supplier_id")
    before = F.lit(0).cast("long")
    for i, r in enumerate(ranks):
        own = F.element_at("pairs", i + 1)
        share = F.lit(float(spare or 0)) / own
        bound = F.lower(F.lpad(F.hex(F.floor(share * 2.0**48).cast("long")), 12, "0"))
        every = F.lit("g")  # after all hexadecimal digits
        bounds = counts.filter((before < k) & (own > 0)).select(
            "supplier_id", (every if spare is None else F.when(own <= spare, every).otherwise(bound)).alias("_bound")
        )
        events = one.filter(rank == r).select(*[c for c in one.columns if c not in ("direct", "scopes")])
        found.append(shaped(_through_groups(events, reached.join(bounds, "supplier_id"), digest < F.col("_bound"))))
        before = before + own
    place = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col("pair_rank"))
    return top_k_per(union_all(found), ["supplier_id"], [place, F.asc("_digest")], k).drop("_digest")


def events_with_counts(chosen: DataFrame, classes: Classes) -> DataFrame:
    """As ``events_with_suppliers``, with ``alert_count``, the number of pairs that a row stands for: one row
    for each event, counted through groups and classes, so no pair is made. Rows that share an id but
    differ have their pairs made, as the best match decides which of them names a supplier."""
    one, several = _by_id(chosen)
    reached = group_classes(one, classes).groupBy("match_group_id").agg(F.sum("class_size").alias("_reached"))
    named = direct_pairs(one.select("external_event_id", "direct", "scopes"), classes, outer=False, keep_scope=True)
    # a supplier that shares a scope with the event is counted with its class
    only_named = named.filter("NOT _shared").groupBy("external_event_id").agg(F.count(F.lit(1)).alias("_named"))
    total = F.coalesce("_reached", F.lit(0)) + F.coalesce("_named", F.lit(0))
    counted = one.join(F.broadcast(reached), "match_group_id", "left").join(only_named, "external_event_id", "left")
    counted = counted.select(*[one[c] for c in one.columns if c not in ("direct", "scopes")], F.greatest(total, F.lit(1)).cast("long").alias("alert_count"))
    pairs = events_with_suppliers(several, classes).withColumn("alert_count", F.lit(1).cast("long"))
    return counted.unionByName(pairs, allowMissingColumns=True)


def supplier_totals(links: DataFrame, classes: Classes, measures: dict[str, Column]) -> DataFrame:
    """Sums of per-event measures over all matched events of each supplier, each pair once.

    Events are summed to groups and groups to classes; only these totals meet the suppliers. A supplier
    named in the texts adds an event's own values only where none of its scopes covers the event.
    """
    sums = [F.sum(F.col(m)).alias(m) for m in measures]
    values = _each_way(links).select("match_group_id", "scopes", "named", *[c.alias(m) for m, c in measures.items()])
    summed = values.groupBy("match_group_id", "named").agg(F.first("scopes").alias("scopes"), *sums)
    reached = _reached(summed, ["match_group_id", "named"], classes)
    counted = reached.filter("named IS NULL OR _b IS NULL").groupBy("who", "named").agg(*sums)
    return _to_suppliers(counted, classes).groupBy("supplier_id").agg(*sums)


def top_events_per_supplier(links: DataFrame, classes: Classes, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` matched events of each supplier, with the columns of ``links``.

    Only the first ``k`` events of each group, and of those the first ``k`` of each class, can be among
    them, as can only the first ``k`` that name a supplier; all are cut before suppliers are joined. The
    result equals ranking all pairs.
    """
    heads = top_k_per(_each_way(links), ["match_group_id", "named"], order, k)
    reached = top_k_per(_reached(heads, ["external_event_id", "named"], classes), ["who", "named"], order, k)
    pairs = _to_suppliers(_match_of(reached).drop("scopes"), classes)
    best = top_k_per(pairs, ["external_event_id", "supplier_id"], best_order(), 1)
    return top_k_per(best, ["supplier_id"], order, k, rank_col="event_rank")


def event_mart(links: DataFrame, classes: Classes, sku_counts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Events with their matches; unmatched events stay.

    One row per directly matched supplier, else one row for the event. ``match_group_id`` and
    ``group_supplier_count`` describe the suppliers reached through country, region, category
    or fuel. Points are given only to matched events.
    """
    reached = group_classes(links, classes).groupBy("match_group_id").agg(
        F.sum("class_size").alias("group_supplier_count"),
        F.max_by("match_type", F.struct("match_confidence", "match_type", "match_value")).alias("_gt"),
        F.max("match_confidence").alias("_gc"),
    )
    # whole texts do not travel with the pairs: those that differ from the title are joined in the end
    differs = ~F.col("event_summary").eqNullSafe(F.col("event_title"))
    text_key = F.md5(F.coalesce("event_summary", F.lit("")).cast("binary"))
    nothing = F.md5(F.col("external_event_id").cast("binary"))  # spreads the rows that need no text
    summaries = links.filter(differs & F.col("event_summary").isNotNull()).select(text_key.alias("_text"), "event_summary")
    summaries = summaries.groupBy("_text").agg(F.any_value("event_summary").alias("event_summary"))
    thin = links.withColumns({"_differs": differs, "_text": F.when(differs, text_key).otherwise(nothing)}).drop("event_summary")
    pairs = direct_pairs(thin, classes, outer=True)
    matched = F.col("supplier_id").isNotNull() | F.col("group_supplier_count").isNotNull()
    joined = (
        pairs.join(F.broadcast(reached), "match_group_id", "left")
        .join(sku_counts, "supplier_id", "left")
        .join(
            evidence.select(
                "api_run_id",
                F.col("payload_hash").alias("source_payload_hash"),
                F.col("evidence_document_id").alias("evidence_doc_id"),
            ),
            ["api_run_id", "source_payload_hash"],
            "left",
        )
        .join(summaries, "_text", "left")
    )
    return joined.select(
        "external_event_id",
        "source_name",
        "risk_category",
        "event_type",
        "event_title",
        F.when(F.col("_differs"), F.col("event_summary")).otherwise(F.col("event_title")).alias("event_summary"),
        "severity",
        "event_date",
        "event_timestamp",
        "source_url",
        "event_country",
        "event_region",
        "language",
        F.col("supplier_id").alias("matched_supplier_id"),
        F.coalesce("match_type", "_gt", F.lit("none")).alias("match_type"),
        "match_value",
        F.coalesce("match_confidence", "_gc").alias("match_confidence"),
        F.when(F.col("group_supplier_count").isNotNull(), F.col("match_group_id")).alias("match_group_id"),
        F.coalesce("group_supplier_count", F.lit(0)).alias("group_supplier_count"),
        F.coalesce("matched_sku_count", F.lit(0)).alias("matched_sku_count"),
        F.when(matched, severity_points(F.col("severity"))).alias("score_contribution"),
        "evidence_doc_id",
        "api_run_id",
    )


def match_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("source_name", "match_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("score_contribution").alias("matched_count"),
        F.avg("score_contribution").alias("avg_points"),
    )
