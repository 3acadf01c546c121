"""The order lines are joined with their orders once where one table can serve several readers."""

from datetime import date

from riskweave.catalog import scoring as CS
from riskweave.catalog import silver as SV
from riskweave.plans import inputs as I
from riskweave.sources.tables import Tables

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate date"


def _tables(spark, folder):
    day = date(2001, 7, 1)
    lines = [(1, p, s, n, q, 10.0, 0.0, 0.0, "A", day) for n, (p, s, q) in enumerate(
        [(1, 0, 2.0), (1, 0, 3.0), (1, 1, 4.0), (1, 2, 1.0), (2, 1, 7.0), (3, 2, 5.0), (3, None, 1.0), (None, 1, 9.0)]
    )]
    made = {
        "lineitem": (lines, LINES),
        "orders": ([(1, 5, "O", date(2001, 6, 1))], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date"),
        "supplier": ([(0, "S0", 0, 1.0), (1, "S1", 1, 1.0), (1, "S1b", 7, 1.0), (2, "S2", 1, 1.0), (2, "S2b", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey long, s_acctbal double"),
        "nation": ([(0, "N0", 0), (1, "N1", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "R0")], "r_regionkey long, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, str(folder))


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey")


def test_pairs_are_not_joined_to_themselves(spark, tmp_path):
    t = _tables(spark, tmp_path)
    mapping = I.sku_map(t)
    assert _scans(mapping) == 1  # was 2, for the pairs and for their totals
    assert _scans(I.alternates(mapping)) == 1  # was 4
    rows = sorted((r.sku_id, r.supplier_id or "", round(r.dependency_percent, 6), r.is_primary_supplier, r.origin_country) for r in mapping.collect())
    # supplier 2 is held twice, the second row of supplier 1 has no nation
    assert rows == sorted([
        ("SKU_1", "SUP_0", 0.5, True, "N0"), ("SKU_1", "SUP_1", 0.4, False, "N1"), ("SKU_1", "SUP_2", 0.1, False, "N1"), ("SKU_1", "SUP_2", 0.1, False, "N0"),
        ("SKU_2", "SUP_1", 1.0, True, "N1"), ("SKU_3", "SUP_2", round(5 / 6, 6), True, "N1"), ("SKU_3", "SUP_2", round(5 / 6, 6), True, "N0"), ("SKU_3", "", round(1 / 6, 6), None, None),
    ])
    assert sorted((r.primary_supplier_id, r.alternate_supplier_id) for r in I.alternates(mapping).collect()) == [("SUP_0", "SUP_1"), ("SUP_0", "SUP_2"), ("SUP_0", "SUP_2")]


def test_parts_of_scores_are_written_one_by_one(spark, tmp_path):
    t = _tables(spark, tmp_path)
    spark.createDataFrame([(p, f"part {p}", "b", "t", p, 1.0) for p in (1, 2, 3)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert _scans(SV.features(t)) > 0 and _scans(SV.features(t, apart=True)) == 0
    assert same(SV.features(t, apart=True), SV.features(t)) and SV.features(t).count() == 2  # part 1 is not held in stock
    trends, named = CS.trends(t), [f(t) for f in (I.suppliers, I.aliases, I.routes)]
    CS.keep_trends(t)
    I.keep_named(t)
    assert _scans(CS.trends(t)) == 0 and _scans(I.routes(t)) == 0
    assert same(CS.trends(t), trends.select(*CS.trends(t).columns))
    assert all(same(f(t), old) for f, old in zip((I.suppliers, I.aliases, I.routes), named))


def test_kept_dependency_is_the_mart(spark, tmp_path):
    t = _tables(spark, tmp_path)
    whole = SV.dependency(t).select(*SV.SCORED_BY).collect()
    SV.keep_dependency(t)
    assert _scans(SV.dependency(t)) == 0
    assert sorted(map(str, SV.dependency(t).collect())) == sorted(map(str, whole))
