"""Table writes, versions, upserts, run replacement, checks and gates."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import maintenance as M
from riskweave.operators import profiling as P
from riskweave.operators import quality as Q
from riskweave.operators import relational as R
from riskweave.sources import landing as L
from riskweave.sources import tables as S


@pytest.fixture(scope="module")
def db(spark):
    S.ensure_schema(spark, "rw_test")
    return "rw_test"


def test_overwrite_append_and_schema_merge(spark, db):
    name = f"{db}.runs"
    S.write_table(spark.createDataFrame([(1, "a")], "id int, x string"), name)
    S.append_table(spark.createDataFrame([(2, 9.0)], "id int, extra double"), name)
    assert rows(spark.table(name).select("id", "x", "extra")) == [(1, "a", None), (2, None, 9.0)]
    assert S.table_exists(spark, name) and not S.table_exists(spark, f"{db}.nothing")
    assert "runs" in S.list_tables(spark, db)


def test_partitioned_write_and_seed(spark, db):
    name = f"{db}.parts"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    S.write_table(df, name, ["p"])
    assert spark.table(name).filter("p = 'b'").count() == 1
    assert S.seed_if_absent(df, f"{db}.seed") and not S.seed_if_absent(df.limit(0), f"{db}.seed")
    assert spark.table(f"{db}.seed").count() == 2


def test_publish_moves_view_between_versions(spark, db):
    name = f"{db}.scores"
    first = S.publish(spark.createDataFrame([(1, 1.0)], "id int, s double"), name)
    second = S.publish(spark.table(name).withColumn("s", F.col("s") + 1), name)
    assert first != second
    assert rows(spark.table(name)) == [(1, 2.0)] and rows(spark.table(first)) == [(1, 1.0)]


def test_create_as_ensure_and_repair(spark, db):
    S.create_table_as(spark, "SELECT 1 AS a", f"{db}.made")
    schema = T.StructType.fromDDL("a int, b string")
    S.ensure_table(spark, f"{db}.empty", schema)
    assert spark.table(f"{db}.empty").count() == 0
    backup = S.repair_schema(spark, f"{db}.made", ["a", "b"], schema, "t1")
    assert spark.table(backup).count() == 1 and spark.table(f"{db}.made").columns == ["a", "b"]
    assert S.repair_schema(spark, f"{db}.made", ["a", "b"], schema, "t2") is None


def test_upsert_modes_and_rerun(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, x string, n int")
    s = spark.createDataFrame([(2, "B", 20), (3, "C", 30)], "k int, x string, n int")
    full = M.upsert(t, s, ["k"])
    assert rows(full) == [(1, "a", 1), (2, "B", 20), (3, "C", 30)]
    assert rows(M.upsert(full, s, ["k"])) == rows(full)
    assert rows(M.upsert(t, s, ["k"], update_cols=["x"])) == [(1, "a", 1), (2, "B", 2), (3, "C", 30)]
    assert rows(M.upsert(t, s, ["k"], update_cols=["x"], insert=False)) == [(1, "a", 1), (2, "B", 2)]
    with pytest.raises(Exception, match="duplicate merge key"):
        M.upsert(t, s.unionByName(s), ["k"]).collect()


def test_replace_run_is_idempotent_and_delete_keeps_unknown(spark):
    log = spark.createDataFrame([("r1", 1), ("r2", 2), (None, 3)], "run string, n int")
    new = spark.createDataFrame([("r2", 5)], "run string, n int")
    once = M.replace_run(log, new, "run", "r2")
    assert rows(once) == rows(M.replace_run(once, new, "run", "r2")) == [("r1", 1), ("r2", 5), (None, 3)]
    assert M.delete_where(log, F.col("run") == "r1").count() == 2


def test_backfill(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(M.backfill_columns(df, {"b": F.lit("?"), "c": F.lit(1)})) == [(1, "?", 1), (2, "x", 1)]


def test_landing_hash_mask_and_manifest(spark):
    raw = spark.createDataFrame(
        [("a", "b1", "s1", True, "t1", None), ("b", "b1", "s2", True, "t2", "{}"), ("c", "b2", "s1", False, "t3", None)],
        "api_run_id string, ingestion_batch_id string, source_name string, response_ok boolean, fetched_at string, raw_payload_json string",
    )
    landed = L.land_raw(raw)
    assert landed.columns == L.ENVELOPE.names
    assert landed.filter("api_run_id = 'a'").first().payload_hash == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert rows(L.latest_clean_batch(L.batch_manifest(raw, 2))) == [("b1",)]
    assert L.filter_latest_batch(raw, L.batch_manifest(raw, 2)).count() == 2
    masked = spark.createDataFrame([('{"token": "s3"}', "u?token=s3&x=1")], "j string, u string").select(L.mask_secrets(F.col("j"), ["token"]), L.mask_secrets(F.col("u"), ["token"])).first()
    assert tuple(masked) == ('{"token": "***"}', "u?token=***&x=1")


def test_read_payload_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"articles":\n[]}')
    got = L.land_raw(L.read_payload_files(spark, str(tmp_path))).first()
    assert got.raw_payload_json == '{"articles":\n[]}' and got.request_url.endswith("a.json")


def test_checks_find_bad_rows_and_gate_raises(spark):
    df = spark.createDataFrame([("k1", 0.5, "x"), ("k1", 1.5, "y"), (None, None, None)], "k string, share double, kind string")
    checks = Q.check_rows(df, "t", [*Q.not_null_checks(["k"]), Q.range_check("share", 0, 1), Q.in_set_check("kind", ["x"])])
    got = {r.check_name: (r.actual_value, r.status) for r in checks.unionByName(Q.check_unique(df, "t", ["k"], "WARN")).collect()}
    assert got == {"k_not_null": ("1", "FAIL"), "share_in_range": ("1", "FAIL"), "kind_in_domain": ("1", "FAIL"), "unique_k": ("1", "WARN")}
    with pytest.raises(Q.GateError, match="k_not_null"):
        Q.gate(checks)
    Q.gate(checks.filter("status <> 'FAIL'"))


def test_fk_row_count_and_readback(spark, db):
    child = spark.createDataFrame([(1,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert Q.check_fk(child, parent, "c", "fk", {"k": "id"}).first().actual_value == "1"
    S.write_table(parent, f"{db}.parent")
    assert Q.check_readback(spark, f"{db}.parent", parent).first().status == "PASS"
    assert Q.check_row_count(parent, child, "c").first().status == "FAIL"
    inv = {r.table_name: r.table_status for r in Q.table_inventory(spark, [f"{db}.parent", f"{db}.gone"]).collect()}
    assert inv == {f"{db}.parent": "FOUND", f"{db}.gone": "MISSING"}


def test_contract_audit_and_profile(spark):
    audit = Q.audit_contracts(spark, {"a": ["x", "y"], "b": ["x"]}, {"a": ["x"], "b": ["x", "z"], "c": ["x"]})
    assert {r.contract_name: r.contract_status for r in audit.collect()} == {"a": "READY", "b": "NEEDS_ADAPTER_OR_PATCH", "c": "MISSING"}
    df = spark.createDataFrame([(1, "a@x"), (1, None), (None, None)], "k int, customer_email string")
    p = P.profile_table(df, P.Contract("t", ("k",), ("k",))).first()
    assert (p.row_count, p.null_key_rows, p.duplicate_keys, p.pii_like_columns, p.readiness) == (3, 1, 1, "customer_email", "FAIL")
    assert P.drop_pii(df).columns == ["k"]
    assert P.wide_column_numbers(["d_1", "d_2", "d_4", "x"], "d_") == {"count": 3, "first": 1, "last": 4, "contiguous": False}


def test_ranked_structs_are_in_rank_order(spark):
    df = spark.createDataFrame([("k", i, f"n{i}") for i in range(8)], "k string, v int, n string")
    got = R.ranked_structs(df, ["k"], [F.desc("v")], 3, ["n"], "top").first()
    assert [s.n for s in got.top] == ["n7", "n6", "n5"] and got.top_count == 8


def test_orphans_and_top_values(spark):
    c = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert rows(R.orphans(c, c.filter("k = 1"), {"k": "k"})) == [(2,)]
    v = spark.createDataFrame([("a",), ("a",), (None,)], "x string")
    assert rows(R.top_values(v, ["x"], 1)) == [("x", 1, "a", 2, 2 / 3)]
