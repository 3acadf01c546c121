"""Domain tables derived from the given TPC-H-like tables.

Every table is a lazy projection, join or partial-aggregable group of whole input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.functions.cleaning import record_id
from riskweave.functions.risk import common_severity
from riskweave.session import cut_lineage
from riskweave.sources.tables import Tables

# Reference days of the two data families.
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"

# Names used for derived attributes.
CATEGORIES = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
STORES = ("CA_1", "TX_1", "WI_1")
MODES = ("ocean", "truck", "air")
SWITCHING = ("low", "medium", "high")
CALENDAR_START = "1995-01-01"
EXPECTED_LEAD_DAYS = 30
ON_TIME_DAYS = 39
PAYLOAD_EVENTS = 100
PAYLOADS_PER_BATCH = 10
SOURCES = {
    "gdelt": "news_disruption",
    "nws": "weather_logistics",
    "cisa": "cyber",
    "cpsc": "quality_recall",
    "ofac": "sanctions_compliance",
    "sec_edgar": "financial_filing",
    "eia": "fuel_logistics_cost",
}


def pick(values: tuple[str, ...], index: Column) -> Column:
    """Element of a short fixed list by a zero-based number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def lines(t: Tables) -> DataFrame:
    """Order lines with the order's date, status and the days from order to shipping."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date"))
    li = t.lineitem.withColumn("ship_date", F.to_date("l_shipdate"))
    return li.join(o, li.l_orderkey == o.o_orderkey).withColumn("lead_days", F.datediff("ship_date", "order_date"))


#: Tables of suppliers, which matching reads in many places.
NAMED = ("suppliers", "aliases", "routes")


def keep_named(t: Tables) -> None:
    """Write the ``NAMED`` tables, a few rows per supplier, for queries with many steps: else their joins stand
    in the plan wherever a phrase or a scope does, and the driver follows each of them."""
    for name, build in zip(NAMED, (suppliers, aliases, routes), strict=True):
        if name not in t.kept:
            t.kept[name] = cut_lineage(build(t), name)


def suppliers(t: Tables) -> DataFrame:
    if "suppliers" in t.kept:
        return t.kept["suppliers"]
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    s = t.supplier.join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(
        _id("SUP_", "s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.concat("s_name", F.lit(" Holdings")).alias("parent_company"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        pick(CATEGORIES, F.col("s_suppkey") % 8).alias("supplier_category"),
        F.when(F.col("s_acctbal") >= 6416, F.lit("Tier 1"))
        .when(F.col("s_acctbal") >= 2432, F.lit("Tier 2"))
        .otherwise(F.lit("Tier 3"))
        .alias("criticality_tier"),
        F.round(F.col("s_acctbal") * 1000, 2).alias("annual_spend"),
        (F.col("s_suppkey") % 5 == 0).alias("single_source_flag"),
        (7 + F.col("s_suppkey") % 21).cast("int").alias("default_lead_time_days"),
    )


def aliases(t: Tables) -> DataFrame:
    """Full name, code, and the trade names of the parts whose number the supplier shares."""
    if "aliases" in t.kept:
        return t.kept["aliases"]
    key = _id("SUP_", "s_suppkey")
    names = t.supplier.select(
        key.alias("supplier_id"),
        F.explode(
            F.array(
                F.struct(
                    F.col("s_name").alias("alias_name"),
                    F.lit("official").alias("alias_type"),
                    F.lit(0.95).alias("match_confidence"),
                ),
                F.struct(
                    key.alias("alias_name"),
                    F.lit("code").alias("alias_type"),
                    F.lit(0.9).alias("match_confidence"),
                ),
            )
        ).alias("a"),
    ).select("supplier_id", "a.*")
    trade = (
        t.part.join(t.supplier, F.col("p_partkey") == F.col("s_suppkey"))
        .groupBy("p_name")
        .agg(F.min("s_suppkey").alias("s_suppkey"))
        .select(
            key.alias("supplier_id"),
            F.col("p_name").alias("alias_name"),
            F.lit("trade_name").alias("alias_type"),
            F.lit(0.8).alias("match_confidence"),
        )
    )
    return names.unionByName(trade)


def sku_map(t: Tables) -> DataFrame:
    """Supplier x part with the supplier's share of the part's quantity.

    Lines are summed to pairs first; part totals come from the pairs, so no raw line is ever
    ranked and a part with very many lines is already reduced map-side. The totals are taken over the
    part's pairs where they lie, so pairs are shuffled once to meet by part and not joined to themselves.
    """
    pairs = (
        lines(t)
        .groupBy("l_suppkey", "l_partkey")
        .agg(
            F.sum("l_quantity").alias("qty"),
            F.min("l_quantity").cast("int").alias("minimum_order_quantity"),
            F.sum("lead_days").alias("_lead"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    part = W.partitionBy("l_partkey")
    pairs = pairs.filter("l_partkey IS NOT NULL").withColumns(
        {
            "_total": F.sum("qty").over(part),
            "_suppliers": F.count(F.lit(1)).over(part),
            "_top": F.max(F.struct(F.col("qty"), (-F.col("l_suppkey")).alias("k"))).over(part),
        }
    )
    return _with_places(pairs, t).select(
        _id("SUP_", "l_suppkey").alias("supplier_id"),
        _id("SKU_", "l_partkey").alias("sku_id"),
        (F.col("qty") / F.col("_total")).alias("dependency_percent"),
        (F.col("_top.k") == -F.col("l_suppkey")).alias("is_primary_supplier"),
        (F.col("_suppliers") > 1).alias("alternate_supplier_available"),
        F.greatest(F.lit(1), F.abs(F.round(F.col("_lead") / F.col("_n"))).cast("int")).alias("standard_lead_time_days"),
        F.col("n_name").alias("origin_country"),
        F.concat("n_name", F.lit("_PORT")).alias("origin_port"),
        F.concat(F.lit("DC_"), (F.col("l_partkey") % 4).cast("string")).alias("destination_dc"),
        pick(MODES, F.col("l_suppkey") % 3).alias("transport_mode"),
        "minimum_order_quantity",
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_partkey").alias("part_key"),
    )


def _with_places(pairs: DataFrame, t: Tables) -> DataFrame:
    """``pairs`` with ``n_name``, the supplier's nation. Keys and names are joined one after the other: the
    size of a semi join is known, so Spark does not shuffle the pairs as long as the keys are few."""
    nation = t.nation.select("n_nationkey", "n_name")
    known = t.supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    keys = known.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return pairs.join(keys, "l_suppkey", "left").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")


def alternates(mapping: DataFrame) -> DataFrame:
    """Every other supplier of a SKU against its primary one (from ``sku_map``). The SKU's primary rows, mostly
    one, are listed where its pairs lie by part."""
    primary = F.collect_list(F.when(F.col("is_primary_supplier"), F.struct("supplier_id")))
    return (
        mapping.withColumn("_primary", primary.over(W.partitionBy("part_key")))
        .filter(~F.col("is_primary_supplier"))
        .withColumn("_primary", F.explode("_primary"))
        .withColumn("primary_supplier_id", F.col("_primary.supplier_id"))
        .select(
            "sku_id",
            "primary_supplier_id",
            F.col("supplier_id").alias("alternate_supplier_id"),
            ((F.col("supplier_key") + F.col("part_key")) % 4 != 0).alias("approved_flag"),
            pick(SWITCHING, F.col("supplier_key") % 3).alias("switching_cost_level"),
            (5 + F.col("supplier_key") % 30).cast("int").alias("estimated_switch_days"),
            (1 - F.col("dependency_percent")).alias("capacity_available_pct"),
        )
    )


def scorecards(t: Tables) -> DataFrame:
    """Supplier x ship month delivery quality, one partial-aggregated pass over the lines."""
    d = F.col("lead_days")
    n = F.count(F.lit(1))
    return (
        lines(t)
        .groupBy(
            _id("SUP_", "l_suppkey").alias("supplier_id"),
            F.trunc("ship_date", "month").alias("scorecard_month"),
        )
        .agg(
            (1 - F.sum((F.col("l_returnflag") == "R").cast("long")) / n).alias("fill_rate"),
            (F.sum((d <= ON_TIME_DAYS).cast("long")) / n).alias("on_time_delivery_rate"),
            F.avg("l_tax").alias("quality_issue_rate"),
            F.avg(d).alias("avg_lead_time_days"),
            F.var_pop(d).alias("lead_time_variance"),
            F.avg("l_discount").alias("defect_rate"),
        )
        .withColumn("is_deteriorating", F.col("fill_rate") < 0.6)
    )


def purchase_orders(t: Tables) -> DataFrame:
    po = _id("PO_", "l_orderkey")
    return lines(t).select(
        po.alias("po_id"),
        F.concat(po, F.lit("_"), F.col("l_linenumber").cast("string")).alias("po_line_id"),
        _id("SUP_", "l_suppkey").alias("supplier_id"),
        _id("SKU_", "l_partkey").alias("sku_id"),
        "order_date",
        F.date_add("order_date", EXPECTED_LEAD_DAYS).alias("expected_delivery_date"),
        F.col("ship_date").alias("actual_delivery_date"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        F.floor(F.col("l_quantity") * (1 - F.col("l_discount"))).cast("int").alias("quantity_received"),
        F.when(F.col("o_orderstatus") == "F", F.lit("received"))
        .when(F.col("o_orderstatus") == "O", F.lit("open"))
        .otherwise(F.lit("partial"))
        .alias("status"),
    )


def routes(t: Tables) -> DataFrame:
    """Supplier x transport mode; the lines are reduced to distinct pairs before any join."""
    if "routes" in t.kept:
        return t.kept["routes"]
    pairs = t.lineitem.select("l_suppkey", "l_returnflag").distinct()
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    s = t.supplier.join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"))
    mode = (
        F.when(F.col("l_returnflag") == "A", F.lit("ocean"))
        .when(F.col("l_returnflag") == "N", F.lit("truck"))
        .otherwise(F.lit("air"))
    )
    return pairs.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("RT_"), F.col("l_suppkey").cast("string"), F.lit("_"), F.col("l_returnflag")).alias("route_id"),
        _id("SUP_", "l_suppkey").alias("supplier_id"),
        F.col("n_name").alias("origin_country"),
        F.concat("n_name", F.lit("_PORT")).alias("origin_port"),
        F.concat(F.lit("DC_"), F.col("l_returnflag")).alias("destination_dc"),
        mode.alias("transport_mode"),
        F.concat(F.lit("CARRIER_"), (F.col("l_suppkey") % 5).cast("string")).alias("carrier"),
        (10 + F.col("l_suppkey") % 20).cast("int").alias("standard_transit_days"),
        F.when(F.col("l_returnflag") == "R", F.concat("r_name", F.lit(" AIR"))).otherwise(F.col("r_name")).alias("risk_region"),
    )


def week_number(day: Column) -> Column:
    return (F.floor(F.datediff(day, F.lit(CALENDAR_START).cast("date")) / 7) + 11101).cast("int")


def calendar(t: Tables) -> DataFrame:
    """Raw calendar rows: one per distinct order date."""
    d = F.col("date")
    dom = F.dayofmonth(d)
    return (
        t.orders.select(F.to_date("o_orderdate").alias("date"))
        .distinct()
        .select(
            d,
            F.concat(F.lit("d_"), (F.datediff(d, F.lit(CALENDAR_START).cast("date")) + 1).cast("string")).alias("d"),
            week_number(d).alias("wm_yr_wk"),
            F.date_format(d, "EEEE").alias("weekday"),
            F.dayofweek(d).alias("wday"),
            F.month(d).alias("month"),
            F.year(d).alias("year"),
            F.when(dom.isin(1, 15), F.concat(F.lit("Event"), dom.cast("string"))).otherwise(F.lit(" ")).alias("event_name_1"),
            F.when(dom.isin(1, 15), F.lit("Cultural")).otherwise(F.lit("NaN")).alias("event_type_1"),
            F.when((dom == 15) & (F.month(d) == 12), F.lit("YearEnd")).otherwise(F.lit("none")).alias("event_name_2"),
            F.when((dom == 15) & (F.month(d) == 12), F.lit("Sporting")).alias("event_type_2"),
            (dom <= 10).cast("int").alias("snap_CA"),
            dom.between(3, 12).cast("int").alias("snap_TX"),
            dom.between(6, 15).cast("int").alias("snap_WI"),
        )
    )


def _store(c: str) -> Column:
    return pick(STORES, F.col(c) % 3)


def sales_daily(t: Tables) -> DataFrame:
    """Units by item, store and ship date."""
    return (
        t.lineitem.groupBy(
            F.col("l_partkey"), _store("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("calendar_date")
        )
        .agg(F.sum("l_quantity").cast("long").alias("units_sold"))
        .select(
            _id("ITEM_", "l_partkey").alias("item_id"),
            "store_id",
            F.substring("store_id", 1, 2).alias("state_id"),
            "calendar_date",
            F.concat(
                F.lit("d_"),
                (F.datediff("calendar_date", F.lit(CALENDAR_START).cast("date")) + 1).cast("string"),
            ).alias("d"),
            week_number(F.col("calendar_date")).alias("wm_yr_wk"),
            "units_sold",
            "l_partkey",
        )
    )


def prices(t: Tables) -> DataFrame:
    """Average unit price by item, store and week."""
    return (
        t.lineitem.groupBy(
            F.col("l_partkey"), _store("l_suppkey").alias("store_id"), week_number(F.to_date("l_shipdate")).alias("wm_yr_wk")
        )
        .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("sell_price"))
        .select("store_id", _id("ITEM_", "l_partkey").alias("item_id"), "wm_yr_wk", "sell_price")
    )


def sales_wide(t: Tables) -> DataFrame:
    """Units by item and store with one column per month of the year."""
    m = F.month("l_shipdate")
    return (
        t.lineitem.groupBy("l_partkey", _store("l_suppkey").alias("store_id"))
        .agg(*[F.sum(F.when(m == i, F.col("l_quantity")).otherwise(0)).cast("long").alias(f"m_{i}") for i in range(1, 13)])
        .select(
            F.concat(_id("ITEM_", "l_partkey"), F.lit("_"), F.col("store_id")).alias("id"),
            _id("ITEM_", "l_partkey").alias("item_id"),
            "store_id",
            *[f"m_{i}" for i in range(1, 13)],
        )
    )


def inventory(t: Tables) -> DataFrame:
    """Inventory-like snapshot by product, store and ship date, with raw column names."""
    li = t.lineitem.groupBy(
        F.col("l_partkey"), _store("l_suppkey").alias("store"), F.to_date("l_shipdate").alias("day")
    ).agg(
        F.sum("l_quantity").cast("int").alias("sold"),
        F.round(F.sum("l_tax") * 100).cast("int").alias("ordered"),
        F.avg("l_discount").alias("disc"),
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("price"),
    )
    p = t.part.select("p_partkey", "p_type", "p_size", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("day").alias("Date"),
        F.col("store").alias("Store ID"),
        F.concat(F.lit("P_"), F.col("l_partkey").cast("string")).alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.substring("store", 1, 2).alias("Region"),
        (F.col("p_size") * 10).cast("int").alias("Inventory Level"),
        F.col("sold").alias("Units Sold"),
        F.col("ordered").alias("Units Ordered"),
        (F.col("sold") - 25).cast("double").alias("Demand Forecast"),
        F.col("price").alias("Price"),
        F.col("disc").alias("Discount"),
        F.lit("Sunny").alias("Weather Condition"),
        (F.dayofmonth("day").isin(1, 15)).cast("int").alias("Holiday/Promotion"),
        (F.col("price") * 0.97).alias("Competitor Pricing"),
        F.col("p_brand").alias("Seasonality"),
    )


def crosswalk(t: Tables) -> DataFrame:
    """Ids of one product in three systems: every part in the first, two thirds in the others."""
    k = F.col("p_partkey")
    num = k.cast("string")
    row = lambda system, pid, conf: F.struct(
        F.lit(system).alias("source_system"), pid.alias("source_product_id"), F.lit(conf).alias("confidence")
    )
    entries = F.array(
        row("m5", F.concat(F.lit("ITEM_"), num), 1.0),
        F.when(k % 3 != 1, row("retail_inventory", F.concat(F.lit("P_"), num), 0.9)),
        F.when(k % 3 != 2, row("dataco", num, 0.8)),
    )
    return (
        t.part.select(
            F.concat(F.lit("SKU_"), num).alias("canonical_sku_id"),
            F.explode(F.filter(entries, lambda e: e.isNotNull())).alias("e"),
            F.col("p_name").alias("source_product_name"),
            F.col("p_type").alias("source_category"),
            F.col("p_brand").alias("source_department"),
        )
        .select(
            "canonical_sku_id",
            "e.source_system",
            "e.source_product_id",
            "source_product_name",
            "source_category",
            "source_department",
            "e.confidence",
            F.lit("native_id").alias("mapping_rule"),
        )
    )


def raw_orders(t: Tables) -> DataFrame:
    """Order-line extract with spaced names, text dates and personal columns."""
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    x = lines(t).join(c, F.col("o_custkey") == F.col("c_custkey"))
    return x.select(
        F.col("l_orderkey").alias("Order Id"),
        F.col("l_linenumber").alias("Order Item Id"),
        F.col("l_partkey").alias("Product Card Id"),
        F.date_format("order_date", "M/d/yyyy H:mm").alias("order date (DateOrders)"),
        F.date_format("ship_date", "yyyy-MM-dd HH:mm:ss").alias("shipping date (DateOrders)"),
        (F.col("lead_days") > EXPECTED_LEAD_DAYS).cast("int").alias("Late_delivery_risk"),
        F.col("lead_days").alias("Days for shipping (real)"),
        F.lit(EXPECTED_LEAD_DAYS).alias("Days for shipment (scheduled)"),
        F.when(F.col("l_returnflag") == "R", F.lit(" SUSPECTED_FRAUD "))
        .when(F.col("o_orderstatus") == "P", F.lit("CANCELED"))
        .otherwise(F.lit("COMPLETE"))
        .alias("Order Status"),
        F.col("c_name").alias("Customer Fname"),
        F.concat("c_name", F.lit("@example.com")).alias("Customer Email"),
        F.col("c_mktsegment").alias("Customer Segment"),
        F.col("l_quantity").cast("int").alias("Order Item Quantity"),
        F.col("l_extendedprice").alias("Sales"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).alias("Order Item Total"),
        F.round(F.col("l_extendedprice") * (F.col("l_tax") - F.col("l_discount")), 2).alias("Order Profit Per Order"),
    )


def source_name() -> Column:
    """Source of an event row, from its type, value and payload number."""
    k, kind = F.col("k"), F.col("event_type")
    return (
        F.when((kind == "click") & (k < 90), F.lit("gdelt"))
        .when(kind == "click", F.lit("sec_edgar"))
        .when(kind == "error", F.lit("cisa"))
        .when(kind == "view", F.lit("nws"))
        .when(kind == "signup", F.lit("ofac"))
        .when(F.col("value") >= 50, F.lit("cpsc"))
        .otherwise(F.lit("eia"))
    )


def raw_severity() -> Column:
    v = F.col("value")
    return (
        F.when(v >= 200, F.lit("Extreme"))
        .when(v >= 100, F.lit("severe"))
        .when(v >= 50, F.lit(" moderate"))
        .when(v >= 10, F.lit("minor"))
        .when(v >= 5, F.lit("Advisory"))
        .otherwise(F.lit("n/a"))
    )


def event_rows(t: Tables) -> DataFrame:
    """Events with the attributes every derived event table shares."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = t.events.withColumn("k", k).withColumn("source_name", source_name())
    p = t.part.select(F.col("p_partkey").cast("long").alias("k"), "p_name")
    r = t.region.select(F.col("r_regionkey"), "r_name")
    return (
        e.join(p, "k", "left")
        .join(F.broadcast(r), F.col("k") % 5 == F.col("r_regionkey"), "left")
        .select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "value",
            "k",
            "source_name",
            F.to_date("ts").alias("event_date"),
            F.floor(F.col("event_id") / PAYLOAD_EVENTS).cast("long").alias("payload_no"),
            F.concat(
                F.col("event_type"),
                F.lit(" notice: "),
                F.coalesce("p_name", F.lit("goods")),
                F.lit(" from Supplier#"),
                F.lpad(F.col("user_id").cast("string"), 9, "0"),
            ).alias("title"),
            F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("country"),
            F.concat(F.col("r_name"), F.when(F.col("k") % 2 == 0, F.lit(" COAST")).otherwise(F.lit(""))).alias("region"),
        )
    )


def _run_id() -> Column:
    return F.concat(F.col("source_name"), F.lit("_run_"), F.col("payload_no").cast("string"))


def external_events(t: Tables) -> DataFrame:
    """Clean external events: the title names a part and a supplier, the summary is the whole
    text of the document with the same number where there is one."""
    docs = t.documents.select(F.col("doc_id").alias("event_id"), F.col("text").alias("doc_text"))
    category = F.create_map(*[F.lit(x) for kv in SOURCES.items() for x in kv])
    return (
        event_rows(t)
        .join(docs, "event_id", "left")
        .select(
            record_id(F.col("source_name"), F.col("event_id")).alias("external_event_id"),
            "event_id",
            "source_name",
            F.element_at(category, F.col("source_name")).alias("risk_category"),
            "event_type",
            F.col("title").alias("event_title"),
            F.coalesce("doc_text", "title").alias("event_summary"),
            common_severity(raw_severity()).alias("severity"),
            "event_date",
            F.col("ts").alias("event_timestamp"),
            F.concat(F.lit("https://example.org/e/"), F.col("event_id").cast("string")).alias("source_url"),
            F.col("country").alias("event_country"),
            F.when(F.col("source_name").isin("nws", "gdelt"), F.col("region")).alias("event_region"),
            F.lit("en").alias("language"),
            _run_id().alias("api_run_id"),
            F.sha2(_run_id(), 256).alias("source_payload_hash"),
        )
    )


def evidence_documents(t: Tables) -> DataFrame:
    """One evidence document per payload run."""
    return (
        event_rows(t)
        .select("source_name", "payload_no")
        .distinct()
        .select(
            _run_id().alias("api_run_id"),
            F.sha2(_run_id(), 256).alias("payload_hash"),
            F.concat(F.lit("DOC_"), _run_id()).alias("evidence_document_id"),
        )
    )


def payloads(t: Tables) -> DataFrame:
    """Raw payload rows: up to 100 consecutive events of one source as one JSON text.

    The list is bounded by the payload size, never by a source or a day. In every odd batch the
    weather calls fail and carry no payload.
    """
    e = event_rows(t)
    eid = F.col("event_id").cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    day = q(F.date_format("ts", "yyyy-MM-dd"))
    item = (
        F.when(
            F.col("source_name") == "gdelt",
            F.concat(
                F.lit('{"url":"https://example.org/e/'), eid, F.lit('","title":'), q(F.col("title")),
                F.lit(',"seendate":'), q(F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("T"), F.date_format("ts", "HHmmss"), F.lit("Z"))),
                F.lit(',"domain":"example.org","language":"English","sourcecountry":'), q(F.col("country")), F.lit("}"),
            ),
        )
        .when(
            F.col("source_name") == "nws",
            F.concat(
                F.lit('{"id":"w'), eid, F.lit('","properties":{"event":'), q(F.col("event_type")),
                F.lit(',"severity":'), q(raw_severity()), F.lit(',"areaDesc":'), q(F.col("region")),
                F.lit(',"headline":'), q(F.col("title")), F.lit(',"description":'), q(F.col("title")),
                F.lit(',"onset":'), q(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), F.lit(',"senderName":"station"}}'),
            ),
        )
        .when(
            F.col("source_name") == "cisa",
            F.concat(
                F.lit('{"cveID":"CVE-'), eid, F.lit('","vulnerabilityName":'), q(F.col("title")),
                F.lit(',"dateAdded":'), day, F.lit(',"shortDescription":'), q(F.col("title")),
                F.lit(',"knownRansomwareCampaignUse":'),
                q(F.when(F.col("value") >= 50, F.lit("Known")).otherwise(F.lit("Unknown"))), F.lit("}"),
            ),
        )
        .when(
            F.col("source_name") == "cpsc",
            F.concat(
                F.lit('{"RecallNumber":"R'), eid, F.lit('","RecallDate":'), day,
                F.lit(',"Title":'), q(F.col("title")), F.lit(',"Description":'), q(F.col("title")),
                F.lit(',"URL":"https://example.org/r/'), eid, F.lit('"}'),
            ),
        )
        .otherwise(F.concat(F.lit('{"n":'), eid, F.lit("}")))
    )
    grouped = (
        e.withColumn("item", item)
        .groupBy("source_name", "payload_no")
        .agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda s: s["item"]), ","
            ).alias("items"),
            F.max("ts").alias("fetched"),
        )
    )
    head = (
        F.when(F.col("source_name") == "gdelt", F.lit('{"articles":['))
        .when(F.col("source_name") == "nws", F.lit('{"type":"FeatureCollection","features":['))
        .when(F.col("source_name") == "cisa", F.lit('{"vulnerabilities":['))
        .when(F.col("source_name") == "cpsc", F.lit("["))
        .otherwise(F.lit('{"rows":['))
    )
    tail = F.when(F.col("source_name") == "cpsc", F.lit("]")).otherwise(F.lit("]}"))
    batch = F.floor(F.col("payload_no") / PAYLOADS_PER_BATCH).cast("long")
    failed = (batch % 2 == 1) & (F.col("source_name") == "nws")
    return grouped.select(
        _run_id().alias("api_run_id"),
        F.concat(F.lit("batch_"), F.lpad(batch.cast("string"), 12, "0")).alias("ingestion_batch_id"),
        "source_name",
        F.concat("source_name", F.lit("_feed")).alias("endpoint_name"),
        F.concat(
            F.lit("https://example.org/"), F.col("source_name"), F.lit("?page="), F.col("payload_no").cast("string"), F.lit("&api_key=k"), F.col("payload_no").cast("string")
        ).alias("request_url"),
        F.concat(F.lit('{"page": "'), F.col("payload_no").cast("string"), F.lit('", "api_key": "secret'), F.col("payload_no").cast("string"), F.lit('"}')).alias("query_params_json"),
        F.lit("{}").alias("request_headers_json"),
        F.when(failed, F.lit(500)).otherwise(F.lit(200)).alias("response_status_code"),
        (~failed).alias("response_ok"),
        F.date_format("fetched", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
        F.when(~failed, F.concat(head, F.col("items"), tail)).alias("raw_payload_json"),
        F.when(failed, F.lit("server error")).alias("error_message"),
    )


def vectors(t: Tables) -> DataFrame:
    """Evidence chunks with their vectors: documents joined to embeddings by number."""
    e = t.embeddings
    d = t.documents
    kinds = ("risk_explanation", "external_event", "external_event", "note")
    categories = ("supplier_risk", "cyber", "weather", "logistics", "misc")
    names = ("internal_risk_engine", "gdelt", "nws", "cisa", "blog")
    return e.join(d, e.vec_id == d.doc_id).select(
        F.concat(F.lit("CH_"), F.col("vec_id").cast("string")).alias("chunk_id"),
        pick(kinds, F.col("doc_id") % 4).alias("chunk_type"),
        F.when(F.col("label") < 8, F.concat(F.lit("SUP_"), F.col("label").cast("string"))).alias("supplier_id"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("SKU_"), (F.col("doc_id") % 3).cast("string"))).alias("sku_id"),
        pick(names, F.col("n_chars") % 5).alias("source_name"),
        pick(categories, F.col("doc_id") % 5).alias("risk_category"),
        F.date_sub(F.lit(EVENTS_AS_OF).cast("date"), (F.col("n_chars") % 400).cast("int")).alias("event_date"),
        F.when(F.col("n_chars") >= 4000, F.lit("critical"))
        .when(F.col("n_chars") >= 2000, F.lit("high"))
        .when(F.col("n_chars") >= 800, F.lit("medium"))
        .otherwise(F.lit("low"))
        .alias("severity"),
        F.col("text").alias("chunk_text"),
        "label",
        "vec_id",
        "embedding",
    )
