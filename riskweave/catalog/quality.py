"""Profiles, checks and audits over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.catalog.registry import query
from riskweave.catalog.shape import tidy
from riskweave.operators import profiling as P
from riskweave.operators import quality as Q
from riskweave.operators.relational import top_values, union_all
from riskweave.plans import events as E
from riskweave.plans import inputs as I
from riskweave.plans import marts, silver
from riskweave.sources import landing as L

CONTRACTS = {
    "customer": P.Contract("customer", ("c_custkey", "c_name", "c_email"), ("c_custkey",), (), ("c_mktsegment",), ("c_acctbal",)),
    "orders": P.Contract("orders", ("o_orderkey", "o_custkey"), ("o_orderkey",), ("o_orderdate",), ("o_orderstatus", "o_orderpriority"), ("o_totalprice",)),
    "lineitem": P.Contract("lineitem", ("l_orderkey", "l_partkey"), ("l_partkey", "l_suppkey"), ("l_shipdate",), ("l_returnflag", "l_linestatus"), ("l_quantity", "l_tax")),
}


@query("contract_registry", "Q01 V10")
def _(t):
    """Contracts next to the row counts of the tables they describe."""
    counts = union_all([t[n].agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(n)) for n in CONTRACTS])
    return P.contracts_df(t.spark, list(CONTRACTS.values())).join(counts, "table_name")


def _profile_sql(n: str, cols: int, missing: str, keys: str, pii: str = "") -> str:
    return (
        f"SELECT '{n}' AS table_name, CAST(sum(c) AS BIGINT) AS row_count, {cols}::BIGINT AS column_count, '{missing}' AS missing_required, 0::BIGINT AS null_key_rows, count(*) FILTER (c > 1) AS duplicate_keys,"
        f" '{pii}' AS pii_like_columns, CASE WHEN '{missing}' <> '' THEN 'FAIL' WHEN count(*) FILTER (c > 1) > 0 THEN 'WARN' ELSE 'PASS' END AS readiness FROM (SELECT {keys}, count(*) AS c FROM {n} GROUP BY ALL)"
    )


@query("profile_tables", "Q02", "\nUNION ALL ".join([_profile_sql("customer", 5, "c_email", "c_custkey"), _profile_sql("orders", 6, "", "o_orderkey"), _profile_sql("lineitem", 11, "", "l_partkey, l_suppkey")]))
def _(t):
    return tidy(union_all([P.profile_table(t[n], c) for n, c in CONTRACTS.items()]))


@query("number_gaps", "Q03", "SELECT count(DISTINCT p_partkey) AS number_count, min(p_partkey) AS first_number, max(p_partkey) AS last_number, max(p_partkey) - min(p_partkey) + 1 = count(DISTINCT p_partkey) AS is_contiguous FROM part")
def _(t):
    return P.number_gaps(t.part, "p_partkey")


def _column_sql(table: str, cols: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, '{role}' AS column_role, count(*) AS row_count, count(*) - count({c}) AS null_count, 0.0::DOUBLE AS null_share, count(DISTINCT {c}) AS distinct_count FROM {table}"
        for c, (kind, role) in cols.items()
    )


@query("profile_columns_exact", "Q04", _column_sql("orders", {
    "o_orderkey": ("bigint", "keys"), "o_custkey": ("bigint", "other"), "o_orderstatus": ("string", "categorical"), "o_totalprice": ("double", "numeric"), "o_orderdate": ("timestamp_ntz", "dates"), "o_orderpriority": ("string", "categorical"),
}))
def _(t):
    return tidy(P.profile_columns(t.orders, CONTRACTS["orders"], exact=True).drop("table_name", "min_value", "max_value"))


@query("profile_columns", "Q04 A04")
def _(t):
    return P.profile_columns(t.lineitem, CONTRACTS["lineitem"])


@query("profile_categorical", "Q05 T02", """
SELECT column_name, r AS value_rank, value, value_count, rnd(value_count / total, 4) AS value_share FROM (
  SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value NULLS FIRST) AS r, sum(value_count) OVER (PARTITION BY column_name) AS total FROM (
    SELECT 'l_returnflag' AS column_name, l_returnflag AS value, count(*) AS value_count FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2)) WHERE r <= 20
""")
def _(t):
    return tidy(top_values(t.lineitem, list(CONTRACTS["lineitem"].categorical), 20))


@query("profile_numeric", "Q06 A05 A06")
def _(t):
    return P.profile_numeric(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("numeric_moments", "Q06", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, rnd(min({c}), 4) AS min_value, rnd(max({c}), 4) AS max_value, rnd(avg({c}), 4) AS avg_value, rnd(stddev_samp({c}), 4) AS stddev_value FROM orders" for c in ("o_totalprice",)
))
def _(t):
    return tidy(P.profile_numeric(t.orders, ["o_totalprice"]).select("column_name", "row_count", "min_value", "max_value", "avg_value", "stddev_value"))


RESULT = "'{t}' AS table_name, '{c}' AS check_name, {e}::VARCHAR AS expected_value, ({a})::VARCHAR AS actual_value, CASE WHEN ({a}) = {e} THEN 'PASS' ELSE '{f}' END AS status"


def _res(table: str, check: str, actual: str, src: str, expected: str = "0", fail: str = "FAIL") -> str:
    return "SELECT " + RESULT.format(t=table, c=check, e=expected, a=actual, f=fail) + f" FROM {src}"


@query("row_checks", "Q07 Q10 Q11 Q12 Q14 A07 F01 F02 F03", "\nUNION ALL ".join([
    _res("lineitem", "l_orderkey_not_null", "count(*) FILTER (l_orderkey IS NULL)", "lineitem"),
    _res("lineitem", "l_partkey_not_null", "count(*) FILTER (l_partkey IS NULL)", "lineitem"),
    _res("lineitem", "l_returnflag_in_domain", "count(*) FILTER (l_returnflag NOT IN ('A', 'N'))", "lineitem"),
    _res("lineitem", "l_discount_in_range", "count(*) FILTER (l_discount < 0 OR l_discount > 0.05)", "lineitem", fail="WARN"),
    _res("lineitem", "l_quantity_in_range", "count(*) FILTER (l_quantity < 0)", "lineitem"),
]))
def _(t):
    checks = Q.not_null_checks(["l_orderkey", "l_partkey"]) + [
        Q.in_set_check("l_returnflag", ["A", "N"]), Q.range_check("l_discount", 0, 0.05, "WARN"), Q.range_check("l_quantity", 0),
    ]
    return Q.check_rows(t.lineitem, "lineitem", checks)


@query("row_count_preserved", "Q08", _res("unpivoted", "row_count_preserved", "(SELECT count(*) * 12 FROM (SELECT DISTINCT l_partkey, l_suppkey % 3 FROM lineitem))", "(SELECT 1)", "(SELECT count(*) * 12 FROM (SELECT DISTINCT l_partkey, l_suppkey % 3 FROM lineitem))"))
def _(t):
    wide = I.sales_wide(t)
    return Q.check_row_count(wide, silver.unpivot_numbered(wide, ["id"], "m_", "m", "v"), "unpivoted", 12)


@query("unique_grain", "Q09", "\nUNION ALL ".join([
    _res("orders", "unique_o_orderkey", "(SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))", "(SELECT 1)"),
    _res("lineitem", "unique_l_partkey_l_suppkey", "(SELECT count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))", "(SELECT 1)", fail="WARN"),
]))
def _(t):
    return Q.check_unique(t.orders, "orders", ["o_orderkey"]).unionByName(Q.check_unique(t.lineitem, "lineitem", ["l_partkey", "l_suppkey"], "WARN"))


FKS = {
    "lineitem_orders": ("lineitem", "orders", "l_orderkey", "o_orderkey"),
    "lineitem_part": ("lineitem", "part", "l_partkey", "p_partkey"),
    "lineitem_supplier": ("lineitem", "supplier", "l_suppkey", "s_suppkey"),
    "orders_customer": ("orders", "customer", "o_custkey", "c_custkey"),
    "customer_nation": ("customer", "nation", "c_nationkey", "n_nationkey"),
    "supplier_nation": ("supplier", "nation", "s_nationkey", "n_nationkey"),
    "nation_region": ("nation", "region", "n_regionkey", "r_regionkey"),
    "labels_documents": ("labels", "documents", "doc_id", "doc_id"),
    "events_documents": ("events", "documents", "event_id", "doc_id"),
    "embeddings_documents": ("embeddings", "documents", "vec_id", "doc_id"),
    "pages_documents": ("pages", "documents", "page_id", "doc_id"),
    "events_supplier": ("events", "supplier", "user_id", "s_suppkey"),
}


@query("referential_checks", "Q13 J09", "\nUNION ALL ".join(
    _res(c, f"fk_{n}", f"(SELECT count(*) FROM {c} WHERE {ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {p}))", "(SELECT 1)") for n, (c, p, ck, pk) in FKS.items()
))
def _(t):
    return union_all([Q.check_fk(t[c].select(ck), t[p].select(pk), c, f"fk_{n}", {ck: pk}) for n, (c, p, ck, pk) in FKS.items()])


@query("cross_field_counts", "Q14", _res("inventory", "negative_forecast_flagged", "count(*) FILTER (demand_forecast_raw < 0)", "fx_inventory", "count(*) FILTER (demand_forecast_raw < 0)"))
def _(t):
    inv = silver.build_inventory(I.inventory(t))
    return Q.check_equal_counts(inv, "inventory", "negative_forecast_flagged", F.col("demand_forecast_was_negative"), F.col("demand_forecast_raw") < 0)


@query("group_invariants", "Q15 A08", "\nUNION ALL ".join([
    _res("sku_map", "one_primary_per_sku", "(SELECT count(*) FROM (SELECT sku_id FROM fx_sku_map GROUP BY 1 HAVING count(*) FILTER (is_primary_supplier) <> 1))", "(SELECT 1)"),
    _res("sku_map", "shares_sum_to_one", "(SELECT count(*) FROM (SELECT sku_id FROM fx_sku_map GROUP BY 1 HAVING sum(dependency_percent) NOT BETWEEN 0.95 AND 1.05))", "(SELECT 1)", fail="WARN"),
    _res("sku_map", "at_most_three_suppliers", "(SELECT count(*) FROM (SELECT sku_id FROM fx_sku_map GROUP BY 1 HAVING count(*) > 3))", "(SELECT 1)", fail="WARN"),
]))
def _(t):
    m = I.sku_map(t)
    primary = F.sum(F.col("is_primary_supplier").cast("int"))
    return union_all([
        Q.check_group_invariant(m, "sku_map", "one_primary_per_sku", ["sku_id"], primary, "m <> 1"),
        Q.check_group_invariant(m, "sku_map", "shares_sum_to_one", ["sku_id"], F.sum("dependency_percent"), "m < 0.95 OR m > 1.05", "WARN"),
        Q.check_group_invariant(m, "sku_map", "at_most_three_suppliers", ["sku_id"], F.count(F.lit(1)), "m > 3", "WARN"),
    ])


@query("no_self_reference", "Q16", _res("alternates", "alternate_supplier_id_differs_from_primary_supplier_id", "count(*) FILTER (alternate_supplier_id = primary_supplier_id)", "fx_alternates"))
def _(t):
    a = I.alternates(I.sku_map(t))
    return Q.check_rows(a, "alternates", [Q.no_self_reference("alternate_supplier_id", "primary_supplier_id")])


@query("validate_raw", "Q17", "\nUNION ALL ".join([
    "SELECT 'raw' AS table_name, 'minimum_rows' AS check_name, '1' AS expected_value, (SELECT count(*) FROM fx_payload_runs)::VARCHAR AS actual_value, 'PASS' AS status",
    "SELECT 'raw', 'required_columns', '', '', 'PASS'",
    _res("raw", "api_run_id_not_null", "count(*) FILTER (api_run_id IS NULL)", "fx_payload_runs"),
    _res("raw", "response_ok", "count(*) FILTER (NOT response_ok)", "fx_payload_runs"),
    _res("raw", "payload_not_empty", "count(*) FILTER (NOT response_ok)", "fx_payload_runs"),
    _res("raw", "unique_payload_hash", "CASE WHEN count(*) FILTER (NOT response_ok) > 1 THEN 1 ELSE 0 END", "fx_payload_runs", fail="WARN"),
]))
def _(t):
    return Q.validate_raw(L.land_raw(I.payloads(t)), "raw", ["api_run_id"])


@query("payload_shapes", "Q18 F10", "\nUNION ALL ".join(
    _res("raw", f"shape_{s}", f"count(*) FILTER (NOT response_ok AND source_name = '{s}')", "fx_payload_runs") for s in ("gdelt", "nws", "cisa", "cpsc", "ofac", "sec_edgar", "eia")
))
def _(t):
    return Q.check_shapes(L.land_raw(I.payloads(t)), "raw", E.payload_shapes())


@query("check_rollup", "Q21 M14 U04", """
SELECT audit_source, status, count(*) AS check_count FROM (
  SELECT 'transform_validation' AS audit_source, CASE WHEN (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
  UNION ALL SELECT 'relationship_validation', CASE WHEN (SELECT count(*) FROM events WHERE event_id NOT IN (SELECT doc_id FROM documents)) = 0 THEN 'PASS' ELSE 'FAIL' END
  UNION ALL SELECT 'relationship_validation', CASE WHEN (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 THEN 'PASS' ELSE 'FAIL' END) GROUP BY 1, 2
""")
def _(t):
    transform = Q.check_rows(t.orders, "orders", [Q.range_check("o_totalprice", 0)])
    relation = union_all([Q.check_fk(t[c].select(ck), t[p].select(pk), c, f"fk_{n}", {ck: pk}) for n, (c, p, ck, pk) in FKS.items() if n in ("events_documents", "lineitem_orders")])
    audit = marts.governance_audit(transform, relation)
    return audit.groupBy("audit_source", "status").agg(F.count(F.lit(1)).alias("check_count"))


@query("summarize_checks", "Q21", """
SELECT 'lineitem' AS table_name, status, count(*) AS check_count FROM (
  SELECT CASE WHEN count(*) FILTER (l_tax > 0.05) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem UNION ALL SELECT CASE WHEN count(*) FILTER (l_quantity < 0) = 0 THEN 'PASS' ELSE 'FAIL' END FROM lineitem) GROUP BY 2
""")
def _(t):
    return Q.summarize_checks(Q.check_rows(t.lineitem, "lineitem", [Q.range_check("l_tax", None, 0.05), Q.range_check("l_quantity", 0)]))


@query("minimum_rows", "Q22 T05 V10", "\nUNION ALL ".join(
    f"SELECT '{n}' AS table_name, 'minimum_rows' AS check_name, '100' AS expected_value, least(count(*), 100)::VARCHAR AS actual_value, CASE WHEN count(*) >= 100 THEN 'PASS' ELSE 'FAIL' END AS status FROM {n}" for n in ("nation", "orders", "lineitem")
))
def _(t):
    return union_all([Q.check_min_rows(t[n], n, 100) for n in ("nation", "orders", "lineitem")])


@query("audit_contracts", "Q23")
def _(t):
    have = {n: t[n].columns for n in CONTRACTS}
    audit = Q.audit_contracts(t.spark, have, {**{n: list(c.required) for n, c in CONTRACTS.items()}, "shipments": ["id"]})
    counts = union_all([t[n].agg(F.count(F.lit(1)).alias("row_count")).withColumn("contract_name", F.lit(n)) for n in CONTRACTS])
    return audit.join(counts, "contract_name", "left")


@query("table_health", "Q24", """
SELECT 'orders' AS table_name, 'o_orderdate' AS time_column, count(*) AS row_count, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS newest_value, 'OK' AS table_status FROM orders
UNION ALL SELECT 'lineitem', 'l_shipdate', count(*), strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), 'OK' FROM lineitem UNION ALL SELECT 'part', '', count(*), NULL, 'NO_TIMESTAMP' FROM part
""")
def _(t):
    return Q.table_health({n: t[n] for n in ("orders", "lineitem", "part")}, ["updated_at", "o_orderdate", "l_shipdate"])


@query("embedding_checks", "Q25", "\nUNION ALL ".join([
    _res("embeddings", "vector_not_null", "count(*) FILTER (embedding IS NULL)", "embeddings"),
    _res("embeddings", "vector_not_empty", "count(*) FILTER (len(embedding) = 0)", "embeddings"),
    _res("embeddings", "vector_length", "count(*) FILTER (len(embedding) <> 64)", "embeddings"),
    _res("embeddings", "unique_vec_id", "(SELECT count(*) FROM (SELECT vec_id FROM embeddings GROUP BY 1 HAVING count(*) > 1))", "(SELECT 1)"),
]))
def _(t):
    return Q.check_embeddings(t.embeddings, "embeddings", "vec_id", "embedding", 64)

