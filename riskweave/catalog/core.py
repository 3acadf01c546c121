"""Cleaning, predicates, maintenance and the relational shapes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.catalog import blocks  # noqa: F401
from riskweave.catalog.registry import query
from riskweave.catalog.shape import tidy
from riskweave.functions import cleaning as C
from riskweave.functions import predicates as P
from riskweave.functions import risk
from riskweave.operators import maintenance as M
from riskweave.operators import profiling as PR
from riskweave.operators import relational as R
from riskweave.plans import inputs as I
from riskweave.plans import marts, silver
from riskweave.sources import landing as L
from riskweave.sources.tables import align_schema, table_counts

# ---- P: projections, cleaning, keys ---------------------------------------------------------


@query("clean_string", "P01", """
SELECT conv_id, turn, CASE WHEN lower(trim(w, ' ')) IN ('', 'null', 'none', 'nan') THEN NULL ELSE trim(w, ' ') END AS cleaned
FROM (SELECT conv_id, turn, CASE role WHEN 'system' THEN ' NaN ' WHEN 'user' THEN '  ' || text || ' ' ELSE text END AS w FROM conversations)
""")
def _(t):
    w = (
        F.when(F.col("role") == "system", F.lit(" NaN "))
        .when(F.col("role") == "user", F.concat(F.lit("  "), "text", F.lit(" ")))
        .otherwise(F.col("text"))
    )
    return t.conversations.select("conv_id", "turn", C.clean_string(w).alias("cleaned"))


@query("resolve_columns", "P02 P04", """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, rnd(l_extendedprice, 2) AS sales FROM fx_lines JOIN customer ON o_custkey = c_custkey
""")
def _(t):
    spec = {"order_id": ["ORDER ID"], "order_item_id": ["orderitemid"], "sales": ["gross", "sales"]}
    return tidy(C.resolve_columns(I.raw_orders(t), spec), 2)


@query("first_existing", "P03", "SELECT c_custkey, c_mktsegment AS segment, 0.5::DOUBLE AS weight, NULL::VARCHAR AS missing FROM customer")
def _(t):
    c = t.customer
    return c.select(
        "c_custkey",
        C.first_existing(c, ["segment", "c_mktsegment"]).alias("segment"),
        C.first_existing(c, ["weight"], "double", 0.5).alias("weight"),
        C.first_existing(c, ["nothing"]).alias("missing"),
    )


@query("parse_timestamps", "P05", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') AS parsed_a, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d %H:%M:%S') AS parsed_b,
  NULL::VARCHAR AS parsed_bad FROM orders
""")
def _(t):
    d = F.to_date("o_orderdate")
    return tidy(
        t.orders.select(
            "o_orderkey",
            C.parse_timestamp(F.date_format(d, "M/d/yyyy H:mm")).alias("parsed_a"),
            C.parse_timestamp(F.date_format(d, "yyyy-MM-dd")).alias("parsed_b"),
            C.parse_timestamp(F.concat(F.lit("on "), d.cast("string"))).alias("parsed_bad"),
        )
    )


@query("parse_month", "P06", """
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS from_text, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS from_day,
  NULL::VARCHAR AS from_bad FROM orders
""")
def _(t):
    return tidy(
        t.orders.select(
            "o_orderkey",
            C.parse_month(F.date_format("o_orderdate", "yyyy-MM")).alias("from_text"),
            C.parse_month(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("from_day"),
            C.parse_month(F.col("o_orderpriority")).alias("from_bad"),
        )
    )


@query("record_id", "P07", "SELECT l_orderkey, l_linenumber, sha256(l_orderkey || '||' || l_linenumber || '||' || l_returnflag) AS record_id FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", C.record_id("l_orderkey", "l_linenumber", "l_returnflag").alias("record_id"))


@query("short_id", "P08", "SELECT c_custkey, 'cust_' || substr(sha256(c_name), 1, 24) AS short_id FROM customer")
def _(t):
    return t.customer.select("c_custkey", C.short_id("cust_", "c_name").alias("short_id"))


@query("add_lineage", "P09", "SELECT p_partkey, p_name, 'run_1' AS transform_run_id, '2024-01-30T00:00:00' AS created_at, 'batch' AS created_by, 'parts' AS job_name FROM part")
def _(t):
    return M.add_lineage(t.part.select("p_partkey", "p_name"), "run_1", "2024-01-30T00:00:00", "batch", "parts")


@query("align_schema", "P10", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(s_acctbal AS BIGINT) AS s_acctbal_whole, NULL::VARCHAR AS note, s_name FROM (SELECT *, trunc(s_acctbal) FROM supplier) s(s_suppkey, s_name, s_nationkey, b, s_acctbal)")
def _(t):
    schema = T.StructType.fromDDL("s_suppkey string, s_acctbal_whole bigint, note string, s_name string")
    return align_schema(t.supplier.withColumn("s_acctbal_whole", F.col("s_acctbal")), schema)


@query("field_dictionary", "P18", """
SELECT trim(text, ' ') AS field_name, trim(text, ' ') AS field_description, regexp_replace(regexp_replace(lower(trim(text, ' ')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS field_name_snake,
  regexp_matches(regexp_replace(regexp_replace(lower(trim(text, ' ')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 'email|zip|customer|password|fname|lname|first_name|last_name|street|phone|address|latitude|longitude') AS pii_signal
FROM conversations
""")
def _(t):
    return PR.field_dictionary(t.conversations.select("role", "text"), "text", "text")


@query("drop_pii", "P19", "SELECT l_orderkey AS \"Order Id\", l_linenumber AS \"Order Item Id\", c_mktsegment AS \"Customer Segment\" FROM fx_lines JOIN customer ON o_custkey = c_custkey")
def _(t):
    return PR.drop_pii(I.raw_orders(t).select("Order Id", "Order Item Id", "Customer Fname", "Customer Email", "Customer Segment"))


# ---- F: predicates --------------------------------------------------------------------------


@query("any_null_keys", "F01", """
SELECT count(*) FILTER (c_custkey IS NULL OR o_orderkey IS NULL) AS null_key_rows, count(*) AS row_count
FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def _(t):
    j = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return j.agg(F.count(F.when(P.any_null(["c_custkey", "o_orderkey"]), 1)).alias("null_key_rows"), F.count(F.lit(1)).alias("row_count"))


@query("outside_set", "F02", """
SELECT count(*) FILTER (flag NOT IN ('A', 'N')) AS invalid_rows, count(*) FILTER (flag IS NULL) AS unknown_rows
FROM (SELECT CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS flag FROM lineitem)
""")
def _(t):
    flag = F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    return t.lineitem.agg(
        F.count(F.when(P.outside_set(flag, ["A", "N"]), 1)).alias("invalid_rows"),
        F.count(F.when(flag.isNull(), 1)).alias("unknown_rows"),
    )


@query("out_of_range", "F03", """
SELECT count(*) FILTER (l_discount < 0.01 OR l_discount > 0.09) AS discount_out, count(*) FILTER (l_quantity < 5) AS quantity_low FROM lineitem
""")
def _(t):
    return t.lineitem.agg(
        F.count(F.when(P.out_of_range(F.col("l_discount"), 0.01, 0.09), 1)).alias("discount_out"),
        F.count(F.when(P.out_of_range(F.col("l_quantity"), 5), 1)).alias("quantity_low"),
    )


@query("within_last", "F04", "SELECT event_type, count(*) AS recent_events FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 14 GROUP BY 1")
def _(t):
    return R.distribution(t.events.filter(P.within_last(F.to_date("ts"), I.EVENTS_AS_OF, 14)), ["event_type"], "recent_events")


@query("within_next", "F05", "SELECT o_orderpriority, count(*) AS coming_orders FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-01-15' GROUP BY 1")
def _(t):
    return R.distribution(t.orders.filter(P.within_next(F.to_date("o_orderdate"), "1998-01-01", 14)), ["o_orderpriority"], "coming_orders")


@query("text_overlap", "F06", """
SELECT page_id, contains(lower(url), 'example.com') OR contains('example.com', lower(url)) AS overlaps FROM pages
""")
def _(t):
    return t.pages.select("page_id", P.text_overlap(F.col("url"), F.lit("example.com")).alias("overlaps"))


@query("open_status", "F07", """
SELECT count(*) AS open_rows FROM (SELECT CASE o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'O' THEN 'open' END AS s FROM orders)
WHERE lower(coalesce(s, 'open')) NOT IN ('closed', 'resolved', 'dismissed')
""")
def _(t):
    s = F.when(F.col("o_orderstatus") == "F", F.lit("Closed")).when(F.col("o_orderstatus") == "O", F.lit("open"))
    return t.orders.filter(P.is_open(s)).agg(F.count(F.lit(1)).alias("open_rows"))


@query("scope_or_null", "F09", "SELECT chunk_id, supplier_id FROM fx_vectors WHERE supplier_id = 'SUP_3' OR supplier_id IS NULL")
def _(t):
    return I.vectors(t).filter(P.scope_or_null(F.col("supplier_id"), F.lit("SUP_3"))).select("chunk_id", "supplier_id")


@query("json_shape", "F10", """
SELECT event_type, count(*) FILTER (json_extract(props, '$.k') IS NOT NULL AND substr(props, 1, 1) = '{') AS with_k,
  count(*) FILTER (CAST(json_extract(props, '$.k') AS VARCHAR) = '7') AS k_is_7, count(*) FILTER (contains(props, '9')) AS has_nine FROM events GROUP BY 1
""")
def _(t):
    p = F.col("props")
    return t.events.groupBy("event_type").agg(
        F.count(F.when(P.json_shape(p, paths=["$.k"], starts_with="{"), 1)).alias("with_k"),
        F.count(F.when(P.json_shape(p, equals={"$.k": "7"}), 1)).alias("k_is_7"),
        F.count(F.when(P.json_shape(p, keywords=["9"]), 1)).alias("has_nine"),
    )


# ---- S: maintenance and landing ---------------------------------------------------------------


ALL_TABLES = (
    "region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@query("read_tables_count", "S01 U03", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ALL_TABLES
))
def _(t):
    return table_counts({n: t[n] for n in ALL_TABLES})


@query("replace_run", "S07", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'rerun' ELSE 'first' END AS origin, o_orderstatus FROM orders
""")
def _(t):
    log = t.orders.select("o_orderkey", F.lit("first").alias("origin"), "o_orderstatus")
    again = log.filter("o_orderstatus = 'P'").withColumn("origin", F.lit("rerun"))
    return M.replace_run(log, again, "o_orderstatus", "P")


@query("upsert_all", "S08", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NEW' ELSE c_mktsegment END AS segment FROM customer
UNION ALL SELECT c_custkey + 1000000000, 'NEW' FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def _(t):
    target = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    hit = target.filter("segment = 'BUILDING'").withColumn("segment", F.lit("NEW"))
    source = hit.unionByName(hit.withColumn("c_custkey", F.col("c_custkey") + 1000000000))
    return M.upsert(target, source, ["c_custkey"])


@query("upsert_columns", "S09", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NEW' ELSE c_mktsegment END AS segment, rnd(c_acctbal, 2) AS balance FROM customer
UNION ALL SELECT c_custkey + 1000000000, 'NEW', 0.0 FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def _(t):
    target = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.round("c_acctbal", 2).alias("balance"))
    hit = target.filter("segment = 'BUILDING'").select("c_custkey", F.lit("NEW").alias("segment"), F.lit(0.0).alias("balance"))
    source = hit.unionByName(hit.withColumn("c_custkey", F.col("c_custkey") + 1000000000))
    return M.upsert(target, source, ["c_custkey"], update_cols=["segment"])


@query("delete_where", "S10", "SELECT o_orderkey FROM orders WHERE NOT coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 100000 END, false)")
def _(t):
    cond = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 100000)
    return M.delete_where(t.orders, cond).select("o_orderkey")


@query("backfill_columns", "S11", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand ELSE 'unknown' END AS brand, 1.0::DOUBLE AS confidence FROM part
""")
def _(t):
    p = t.part.select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand"))
    return M.backfill_columns(p, {"brand": F.lit("unknown"), "confidence": F.lit(1.0)})


PAYLOAD_SQL = """
SELECT source_name || '_run_' || payload_no AS api_run_id, source_name, payload_no, payload_no // 10 AS batch_no,
  'batch_' || lpad(CAST(payload_no // 10 AS VARCHAR), 12, '0') AS ingestion_batch_id, max(ts) AS fetched, count(*) AS items,
  NOT ((payload_no // 10) % 2 = 1 AND source_name = 'nws') AS response_ok
FROM fx_event_rows GROUP BY source_name, payload_no
"""
from riskweave.catalog.registry import cte  # noqa: E402

cte("fx_payload_runs", PAYLOAD_SQL)
cte("fx_raw_gdelt", """
SELECT source_name || '_run_' || payload_no AS api_run_id,
  '{"articles":[' || string_agg('{"url":"https://example.org/e/' || event_id || '","title":"' || title || '","seendate":"' || strftime(ts, '%Y%m%dT%H%M%SZ')
  || '","domain":"example.org","language":"English","sourcecountry":"' || country || '"}', ',' ORDER BY event_id) || ']}' AS raw_payload_json
FROM fx_event_rows WHERE source_name = 'gdelt' GROUP BY source_name, payload_no
""")


@query("land_raw", "S16", """
SELECT r.api_run_id, ingestion_batch_id, source_name, CASE WHEN response_ok THEN 200 ELSE 500 END::BIGINT AS response_status_code, response_ok,
  CASE WHEN source_name = 'gdelt' THEN sha256(raw_payload_json) WHEN NOT response_ok THEN sha256('') ELSE 'other' END AS payload_hash
FROM fx_payload_runs r LEFT JOIN fx_raw_gdelt g ON r.api_run_id = g.api_run_id
""")
def _(t):
    raw = L.land_raw(I.payloads(t))
    shown = F.when((F.col("source_name") == "gdelt") | ~F.col("response_ok"), F.col("payload_hash")).otherwise(F.lit("other"))
    return tidy(raw.select("api_run_id", "ingestion_batch_id", "source_name", "response_status_code", "response_ok", shown.alias("payload_hash")))


@query("mask_secrets", "S17", """
SELECT api_run_id, '{"page": "' || payload_no || '", "api_key": "***"}' AS query_params_json,
  'https://example.org/' || source_name || '?page=' || payload_no || '&api_key=***' AS request_url FROM fx_payload_runs
""")
def _(t):
    m = lambda c: L.mask_secrets(F.col(c), ["api_key", "token"]).alias(c)
    return I.payloads(t).select("api_run_id", m("query_params_json"), m("request_url"))


MANIFEST = """
SELECT ingestion_batch_id, count(DISTINCT source_name) FILTER (response_ok) AS source_count, count(*) FILTER (NOT response_ok) AS failure_count,
  strftime(max(fetched), '%Y-%m-%d %H:%M:%S') AS created_at FROM fx_payload_runs GROUP BY 1
"""


@query("batch_manifest", "S18", f"""
SELECT *, CASE WHEN source_count = 7 AND failure_count = 0 THEN 'INGESTED' ELSE 'INCOMPLETE' END AS status FROM ({MANIFEST})
""")
def _(t):
    return L.batch_manifest(I.payloads(t), 7)


@query("latest_batch_rows", "S19", f"""
SELECT api_run_id, ingestion_batch_id, source_name FROM fx_payload_runs WHERE ingestion_batch_id =
  (SELECT ingestion_batch_id FROM ({MANIFEST}) WHERE source_count = 7 AND failure_count = 0 ORDER BY created_at DESC, ingestion_batch_id DESC LIMIT 1)
""")
def _(t):
    raw = I.payloads(t)
    return L.filter_latest_batch(raw, L.batch_manifest(raw, 7)).select("api_run_id", "ingestion_batch_id", "source_name")


@query("api_run_summary", "N09 A10", """
SELECT source_name, count(*) AS call_count, CAST(sum(CAST(response_ok AS INT)) AS BIGINT) AS success_count, CAST(sum(CAST(NOT response_ok AS INT)) AS BIGINT) AS failure_count,
  string_agg(DISTINCT CASE WHEN response_ok THEN '200' ELSE '500' END, ',' ORDER BY CASE WHEN response_ok THEN '200' ELSE '500' END) AS status_codes,
  strftime(max(fetched), '%Y-%m-%d %H:%M:%S') AS latest_fetched_at
FROM fx_payload_runs GROUP BY 1
""")
def _(t):
    return L.api_run_summary(I.payloads(t), ["source_name"])


# ---- J: joins ---------------------------------------------------------------------------------


@query("join_calendar", "J01", """
SELECT s.item_id, s.store_id, s.d, s.units_sold, c.date IS NOT NULL AS in_calendar, CAST(c.year AS BIGINT) AS calendar_year,
  CAST(c.month AS BIGINT) AS month_number, sha256(s.item_id || '||' || s.store_id || '||' || s.d) AS sales_record_id
FROM fx_sales_daily s LEFT JOIN fx_calendar c ON s.d = c.d
""")
def _(t):
    j = silver.join_calendar(I.sales_daily(t), silver.build_calendar(I.calendar(t)))
    return tidy(
        j.select("item_id", "store_id", "d", "units_sold", F.col("calendar_date_id").isNotNull().alias("in_calendar"), "calendar_year", "month_number", "sales_record_id")
    )


@query("sales_price_view", "J02 M09", """
SELECT s.item_id, s.store_id, strftime(s.calendar_date, '%Y-%m-%d') AS calendar_date, s.units_sold, rnd(p.sell_price, 2) AS sell_price, rnd(s.units_sold * p.sell_price, 2) AS estimated_sales_amount, p.sell_price > 0 AS is_valid_price
FROM fx_sales_daily s LEFT JOIN fx_prices p USING (store_id, item_id, wm_yr_wk)
""")
def _(t):
    j = marts.sales_price(I.sales_daily(t), silver.build_prices(I.prices(t)))
    return tidy(j.select("item_id", "store_id", "calendar_date", "units_sold", "sell_price", "estimated_sales_amount", "is_valid_price"), 2)


@query("inventory_view", "J03 M10 F08", """
SELECT strftime(i.inventory_date, '%Y-%m-%d') AS inventory_date, i.store_id, i.product_id, CAST(i.inventory_level AS BIGINT) AS inventory_level, c.canonical_sku_id, c.confidence AS product_mapping_confidence
FROM fx_inventory i LEFT JOIN fx_crosswalk c ON i.product_id = c.source_product_id AND lower(c.source_system) LIKE '%retail%'
""")
def _(t):
    j = marts.inventory_with_sku(silver.build_inventory(I.inventory(t)), I.crosswalk(t))
    return tidy(j.select("inventory_date", "store_id", "product_id", "inventory_level", "canonical_sku_id", "product_mapping_confidence"))


@query("star_join", "J04", """
SELECT c_custkey, coalesce(n, 0) AS order_count, rnd(spend, 2) AS spend, coalesce(big, 0) AS big_orders
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend FROM orders GROUP BY 1) a ON c_custkey = a.o_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS big FROM orders WHERE o_totalprice > 200000 GROUP BY 1) b ON c_custkey = b.o_custkey
""")
def _(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    a = o.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("order_count"), F.sum("o_totalprice").alias("spend"))
    b = o.filter("o_totalprice > 200000").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("big_orders"))
    j = R.star_join(t.customer.select("c_custkey"), [a, b], "c_custkey").fillna(0, ["order_count", "big_orders"])
    return tidy(j.select("c_custkey", "order_count", "spend", "big_orders"), 2)


@query("inner_join_sales_item", "J08", """
SELECT canonical_sku_id, count(*) AS day_rows, CAST(sum(units_sold) AS BIGINT) AS units FROM fx_sales_daily JOIN fx_crosswalk ON item_id = source_product_id AND source_system = 'm5' GROUP BY 1
""")
def _(t):
    cw = I.crosswalk(t).filter("source_system = 'm5'").select(F.col("source_product_id").alias("item_id"), "canonical_sku_id")
    return I.sales_daily(t).join(cw, "item_id").groupBy("canonical_sku_id").agg(F.count(F.lit(1)).alias("day_rows"), F.sum("units_sold").alias("units"))


@query("orphan_parts", "J09 U05", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)")
def _(t):
    return R.orphans(t.part, t.lineitem, {"p_partkey": "l_partkey"}).select("p_partkey")


@query("events_without_document", "J09", "SELECT event_id FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents)")
def _(t):
    return R.orphans(t.events, t.documents, {"event_id": "doc_id"}).select("event_id")


@query("semi_candidates", "J18", "SELECT vec_id, CAST(label AS BIGINT) AS label FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(t):
    ids = t.labels.filter("quality = 1").select(F.col("doc_id").alias("vec_id"))
    return tidy(t.embeddings.join(ids, "vec_id", "left_semi").select("vec_id", "label"))


# ---- A: aggregations --------------------------------------------------------------------------


@query("agg_by_key", "A01", """
SELECT l_suppkey, count(*) AS line_count, CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS returned, rnd(avg(l_quantity), 4) AS avg_qty, max(l_quantity) AS max_qty, min(l_quantity) AS min_qty FROM lineitem GROUP BY 1
""")
def _(t):
    q = F.col("l_quantity")
    return tidy(
        t.lineitem.groupBy("l_suppkey").agg(
            F.count(F.lit(1)).alias("line_count"), F.sum((F.col("l_returnflag") == "R").cast("long")).alias("returned"), F.avg(q).alias("avg_qty"), F.max(q).alias("max_qty"), F.min(q).alias("min_qty")
        )
    )


@query("distinct_counts", "A02", "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"))


@query("distinct_when", "A03", "SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS returned_parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("returned_parts"))


@query("approx_distinct", "A04")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", 0.01).alias("approx_orders"))


@query("approx_percentiles", "A05")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75, 0.95]).alias("p")).select(
        "l_returnflag", *[F.col("p")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75", "p95"))]
    )


@query("sample_stddev", "A06", "SELECT event_type, rnd(stddev_samp(value), 4) AS sd FROM events GROUP BY 1")
def _(t):
    return tidy(t.events.groupBy("event_type").agg(F.stddev("value").alias("sd")))


@query("quality_summary", "A07", """
SELECT count(*) AS row_count, count(*) FILTER (l_quantity <= 0) AS bad_qty, count(*) FILTER (l_discount > 0.1) AS bad_discount,
  count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) AS bad_flag, count(*) FILTER (l_shipdate IS NULL) AS no_ship FROM lineitem
""")
def _(t):
    hit = lambda c: F.count(F.when(c, 1))
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("row_count"), hit(F.col("l_quantity") <= 0).alias("bad_qty"), hit(F.col("l_discount") > 0.1).alias("bad_discount"),
        hit(~F.col("l_returnflag").isin("A", "N", "R")).alias("bad_flag"), hit(F.col("l_shipdate").isNull()).alias("no_ship"),
    )


@query("having_duplicates", "A08", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return R.having(t.lineitem, ["l_partkey", "l_suppkey"], {"n": F.count(F.lit(1))}, "n > 1")


@query("ranked_structs", "A09", """
SELECT l_suppkey, string_agg(l_partkey || ':' || CAST(CAST(q AS BIGINT) AS VARCHAR), ',' ORDER BY r) FILTER (r <= 10) AS top_parts, count(*) AS top_parts_count FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY q DESC, l_partkey) AS r FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)) GROUP BY 1
""")
def _(t):
    g = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").cast("long").alias("q"))
    out = R.ranked_structs(g, ["l_suppkey"], [F.desc("q"), F.asc("l_partkey")], 10, ["l_partkey", "q"], "top_parts")
    text = F.array_join(F.transform("top_parts", lambda s: F.concat_ws(":", s["l_partkey"].cast("string"), s["q"].cast("string"))), ",")
    return out.withColumn("top_parts", text)


@query("first_non_null", "A11", "SELECT o_custkey, min(o_orderpriority) AS any_priority, count(*) AS n FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'urgent' END AS o_orderpriority FROM orders) GROUP BY 1")
def _(t):
    p = F.when(F.col("o_orderstatus") == "F", F.lit("urgent"))
    return t.orders.groupBy("o_custkey").agg(F.first(p, ignorenulls=True).alias("any_priority"), F.count(F.lit(1)).alias("n"))


@query("one_row_per_key", "A12", "SELECT p_name, max(p_brand) AS p_brand, max(p_type) AS p_type FROM part GROUP BY 1")
def _(t):
    return R.one_row_per(t.part, ["p_name"], ["p_brand", "p_type"])


@query("dedupe_on_subset", "A13", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates(["l_suppkey", "l_returnflag", "l_linestatus"])


@query("sum_of_product", "A14", "SELECT l_suppkey, rnd(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1")
def _(t):
    return tidy(t.lineitem.groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")), 2)


@query("flag_rates", "A15", "SELECT l_shipmonth, rnd(avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END), 4) AS return_rate FROM (SELECT strftime(l_shipdate, '%Y-%m') AS l_shipmonth, l_returnflag FROM lineitem) GROUP BY 1")
def _(t):
    return tidy(t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("l_shipmonth")).agg(F.avg((F.col("l_returnflag") == "R").cast("double")).alias("return_rate")))


# ---- W, T: windows, sorting, limits -------------------------------------------------------------


@query("latest_order_per_customer", "W01", "SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def _(t):
    return tidy(R.latest_per(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")]))


@query("dedupe_ordered", "W02", """
SELECT text_key, doc_id, lang FROM (SELECT sha256(text) AS text_key, *, row_number() OVER (PARTITION BY sha256(text) ORDER BY n_chars DESC NULLS LAST, lang NULLS LAST, source NULLS LAST, doc_id NULLS LAST) AS r FROM documents) WHERE r = 1
""")
def _(t):
    d = t.documents.select(F.sha2("text", 256).alias("text_key"), "doc_id", "lang", "n_chars", "source")
    order = [F.desc_nulls_last("n_chars"), F.asc_nulls_last("lang"), F.asc_nulls_last("source"), F.asc_nulls_last("doc_id")]
    return R.top_k_per(d, ["text_key"], order, 1).select("text_key", "doc_id", "lang")


@query("top_k_events_per_user", "W06", "SELECT user_id, event_id, value, r AS value_rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3")
def _(t):
    return tidy(R.top_k_per(t.events.select("user_id", "event_id", "value"), ["user_id"], [F.desc("value"), F.asc("event_id")], 3, "value_rank"))


@query("order_by_status_rank", "T01", "SELECT o_orderstatus, count(*) AS n, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS status_order FROM orders GROUP BY 1 ORDER BY 3")
def _(t):
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return R.distribution(t.orders, ["o_orderstatus"], "n").withColumn("status_order", rank).orderBy("status_order")


@query("top_values", "T02", """
SELECT column_name, r AS value_rank, value, value_count, rnd(value_count / total, 4) AS value_share FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value NULLS FIRST) AS r, sum(value_count) OVER (PARTITION BY column_name) AS total FROM (
    SELECT 'p_brand' AS column_name, p_brand AS value, count(*) AS value_count FROM part GROUP BY 2 UNION ALL SELECT 'p_name', p_name, count(*) FROM part GROUP BY 2)) WHERE r <= 20
""")
def _(t):
    return tidy(R.top_values(t.part, ["p_brand", "p_name"], 20))


@query("latest_event", "T03", "SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def _(t):
    return t.events.orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("event_id", "user_id")


@query("top_50_over_cut", "T04", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 300000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def _(t):
    return t.orders.filter("o_totalprice >= 300000").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@query("existence_probe", "T05", "SELECT least(count(*), 100) AS probed_rows FROM lineitem")
def _(t):
    return t.lineitem.limit(100).agg(F.count(F.lit(1)).alias("probed_rows"))


@query("rank_head", "T06", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer ORDER BY c_mktsegment DESC, c_acctbal DESC, c_custkey DESC LIMIT 12")
def _(t):
    return t.customer.select("c_custkey", "c_acctbal", "c_mktsegment").orderBy(F.desc("c_mktsegment"), F.desc("c_acctbal"), F.desc("c_custkey")).limit(12)


# ---- U: unions ----------------------------------------------------------------------------------


@query("union_by_name", "U01 U02", """
SELECT 'customer' AS party, c_custkey AS party_key, c_name AS party_name, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
""")
def _(t):
    c = t.customer.select(F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"), F.col("c_name").alias("party_name"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_name").alias("party_name"), F.col("s_suppkey").alias("party_key"), F.lit("supplier").alias("party"))
    return R.union_all([c, s], fill=True)


@query("severity_vocabularies", "M04 L07", """
SELECT sev_word AS word, CASE WHEN sev_word IN ('severe','extreme','minor','moderate') THEN sev_word WHEN sev_word = 'advisory' THEN 'medium' ELSE 'unknown' END AS event_severity,
 CASE sev_word WHEN 'extreme' THEN 'critical' WHEN 'severe' THEN 'high' WHEN 'moderate' THEN 'medium' WHEN 'advisory' THEN 'medium' WHEN 'minor' THEN 'low' ELSE 'unknown' END AS common_severity,
 CASE sev_word WHEN 'extreme' THEN 4 WHEN 'severe' THEN 3 WHEN 'moderate' THEN 2 WHEN 'advisory' THEN 2 WHEN 'minor' THEN 1 ELSE 2 END AS severity_rank, count(*) AS n
FROM fx_event_rows GROUP BY 1, 2, 3, 4
""")
def _(t):
    w = I.raw_severity()
    e = I.event_rows(t).select(F.lower(F.trim(w)).alias("word"), risk.normalize_severity(w).alias("event_severity"), risk.common_severity(w).alias("common_severity"))
    return tidy(e.withColumn("severity_rank", risk.severity_rank(F.col("common_severity"))).groupBy("word", "event_severity", "common_severity", "severity_rank").agg(F.count(F.lit(1)).alias("n")))
