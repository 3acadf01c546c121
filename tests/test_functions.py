"""Column functions: null words, lenient parsing, three-valued logic, severity, text."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskweave.functions import cleaning as C
from riskweave.functions import predicates as P
from riskweave.functions import risk
from riskweave.functions import text as T
from riskweave.functions import vectors as V


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("raw,want", [(" ", None), ("NaN", None), (" none ", None), ("NULL", None), (None, None), (" a b ", "a b"), ("nano", "nano")])
def test_clean_string(spark, raw, want):
    assert one(spark, raw, C.clean_string) == want


@pytest.mark.parametrize("raw,want", [("3/7/2018 4:05", dt.datetime(2018, 3, 7, 4, 5)), ("2018-03-07 04:05:06", dt.datetime(2018, 3, 7, 4, 5, 6)), ("2018-03-07", dt.datetime(2018, 3, 7)), ("nope", None), ("13/45/2018 4:05", None), (None, None)])
def test_parse_timestamp(spark, raw, want):
    assert one(spark, raw, C.parse_timestamp) == want


@pytest.mark.parametrize("raw,want", [("2016-05", dt.date(2016, 5, 1)), ("2016-05-17", dt.date(2016, 5, 1)), ("x", None)])
def test_parse_month(spark, raw, want):
    assert one(spark, raw, C.parse_month) == want


def test_record_id_keeps_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert len({r[0] for r in df.select(C.record_id("x", "y")).collect()}) == 2


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1, "a")], ["Order  Id", "Name (x)"])
    assert C.resolve_columns(df, {"order_id": ["order id"], "name": ["nm", "NAME (X)"]}).columns == ["order_id", "name"]
    with pytest.raises(ValueError, match="missing"):
        C.resolve_columns(df, {"missing": ["zip"]})


def test_outside_set_ignores_null(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "x string")
    assert df.filter(P.outside_set(F.col("x"), ["A"])).count() == 1


def test_open_status_null_is_open(spark):
    df = spark.createDataFrame([(None,), ("Closed",), ("new",)], "x string")
    assert df.filter(P.is_open(F.col("x"))).count() == 2


def test_json_shape(spark):
    df = spark.createDataFrame([('{"a":[1],"t":"x"}',), ("null",), (None,), ("[1]",)], "p string")
    got = [r[0] for r in df.select(P.json_shape(F.col("p"), paths=["$.a"], equals={"$.t": "x"})).collect()]
    assert got == [True, False, False, False]


@pytest.mark.parametrize("raw,want", [("Watch", "medium"), ("critical", "high"), ("EXTREME ", "extreme"), ("odd", "unknown"), (None, "unknown")])
def test_normalize_severity(spark, raw, want):
    assert one(spark, raw, risk.normalize_severity) == want


@pytest.mark.parametrize("raw,want", [("extreme", 20), ("severe", 12), ("moderate", 6), ("minor", 2), ("odd", 2)])
def test_severity_points(spark, raw, want):
    assert one(spark, raw, risk.severity_points) == want


def test_sigmoid_edges(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1000.0,), (-1000.0,)], "x double")
    assert [r[0] for r in df.select(risk.sigmoid(F.col("x"))).collect()] == [0.0, 0.5, 1.0, 0.0]


def test_word_runs(spark):
    got = spark.createDataFrame([("A-b c",)], "x string").select(T.word_runs(T.tokens(F.col("x")), 2).alias("g")).first().g
    assert got == ["a b", "b c", "c"]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("<p>Hello\n\n world</p>", "Hello world"),
        ('short "raw_text": {}', T.PAYLOAD_ONLY),
        ("x" * 40 + ' "raw_text": {}', "x" * 40 + T.PAYLOAD_SUFFIX),
        ("a <?xml version='1.0'?>\n<b/>", "a " + T.XML_PLACEHOLDER),
        ("y" * 701, "y" * 701),
        (None, ""),
    ],
)
def test_clean_evidence_text(spark, raw, want):
    assert one(spark, raw, T.clean_evidence_text) == want


def test_evidence_is_cut_only_where_the_caller_says(spark):
    assert one(spark, "y" * 701, lambda c: T.clean_evidence_text(c, 700)) == "y" * 700 + "..."


def test_labelled_value_and_leaks(spark):
    text = "Supplier: ACME\n  risk band:  High \nRecommendation:\nNone"
    assert one(spark, text, lambda c: T.labelled_value(c, "Risk band")) == "High"
    assert one(spark, text, lambda c: T.labelled_value(c, "Country")) is None
    assert one(spark, text, T.empty_slot_leak) == 1
    assert one(spark, text, T.raw_payload_leak) == 0


def test_cosine_matches_batch_and_zero_vector(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = df.select(V.cosine(F.col("a"), F.col("b")).alias("x"), V.cosine_batch("a", "b").alias("y")).collect()
    assert got[0].x == pytest.approx(0.8) and got[0].y == pytest.approx(0.8)
    assert got[1].x == 0.0 and got[1].y == 0.0
    assert rows(df.limit(0).select(V.cosine_batch("a", "b"))) == []
