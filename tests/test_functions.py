"""Routing, clean-up, rules, provenance."""

import math
import zlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidesync.functions import cleaning as C
from tidesync.functions.routing import route_expr, with_partition_num
from tidesync.functions.rules import apply_rules, bit_expr, with_provenance

# Fixed edge ids of the routing check.
EDGE_IDS = ["5", "999", "1000", "-5", "abc", "99999999999999999999", None]


def _expected(v, size):
    if v is None:
        return None
    n = int(v) if v.isdigit() else zlib.crc32(v.encode())
    return n // size + 1


def test_route_text_ids_match_zlib(spark):
    df = spark.createDataFrame([(v,) for v in EDGE_IDS], "id string")
    got = {r["id"]: r["partition_num"] for r in with_partition_num(df, "id", 1000).collect()}
    assert got == {v: _expected(v, 1000) for v in EDGE_IDS}


def test_route_integral_fast_path_equals_text_path(spark):
    df = spark.createDataFrame([(v,) for v in [0, 5, 999, 1000, 123456789, -5, -1]], "id long")
    a = df.select("id", route_expr("id", 1000, T.LongType()).alias("p"))
    b = df.select("id", route_expr(F.col("id").cast("string"), 1000, T.StringType()).alias("p"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_route_hashed_customer_names(spark):
    from conftest import SF_SMOKE
    import __spark_entry__ as E
    rows = E.queries()["route_hashed"](spark, SF_SMOKE).collect()
    assert rows and all(r["partition_num"] == zlib.crc32(r["c_name"].encode()) // 100_000_000 + 1 for r in rows)


def test_null_normalise_only_floats(spark):
    df = spark.createDataFrame([(float("nan"), "", None), (1.5, "x", 2)], "v double, s string, i int")
    out = C.null_normalise(df).collect()
    assert out[0]["v"] is None and out[0]["s"] == "" and out[1]["v"] == 1.5


def test_null_tokens_exact(spark):
    df = spark.createDataFrame([("Null",), ("null",), ("NULL",), ("nan",), ("x",)], "s string")
    out = [r["s"] for r in C.null_tokens(df, C.PROCEDURE_NULL_TOKENS).collect()]
    assert out == [None, "null", "NULL", "nan", "x"]
    out2 = [r["s"] for r in C.null_tokens(df, C.TABLE_SYNC_NULL_TOKENS).collect()]
    assert out2 == ["Null", "null", None, None, "x"]


def test_digits_to_int(spark):
    df = spark.createDataFrame([("007",), ("000",), ("12a",), ("",), (None,), ("99999999999999999999",)], "s string")
    out = [r["s"] for r in C.digits_to_int(df).collect()]
    assert out == ["7", "0", "12a", "", None, "99999999999999999999"]
    as_long = [r["s"] for r in C.digits_to_int(df, as_long=["s"]).collect()]
    assert as_long == [7, 0, None, None, None, None]


def test_nested_to_json(spark):
    df = spark.createDataFrame([([1, 2], {"a": 1})], "arr array<int>, m map<string,int>")
    r = C.nested_to_json(df).first()
    assert r["arr"] == "[1,2]" and r["m"] == '{"a":1}'


def test_bit_rule_truth_table(spark):
    df = spark.createDataFrame([(True, 1, "True"), (False, 2, "1"), (None, None, None), (True, 0, "x")],
                               "b boolean, n int, s string")
    out = df.select(bit_expr("b", T.BooleanType()).alias("b"), bit_expr("n", T.IntegerType()).alias("n"),
                    bit_expr("s", T.StringType()).alias("s")).collect()
    assert [tuple(r) for r in out] == [(1, 1, 0), (0, 0, 0), (0, 0, 0), (1, 0, 0)]


def test_apply_rules_matches_db_table_and_column(spark):
    df = spark.createDataFrame([(True, bytes([0, 0, 0, 0, 0, 0, 1, 0]), 2)], "flag boolean, rv binary, other int")
    rules = [{"target_db": "d", "target_table": "t", "column_name": "flag", "covert_data_type": "bit"},
             {"target_db": "d", "target_table": "t", "column_name": "rv", "covert_data_type": "bigint"},
             {"target_db": "d", "target_table": "x", "column_name": "other", "covert_data_type": "bit"},
             {"target_db": "d", "target_table": "t", "column_name": "nope", "covert_data_type": "bit"}]
    r = apply_rules(df, rules, "d", "t").first()
    assert r["flag"] == 1 and int(r["rv"]) == 256 and r["other"] == 2


def test_procedure_clean_and_provenance(spark):
    df = spark.createDataFrame([("Null", "0042", float("nan"))], "a string, b string, c double")
    r = with_provenance(C.procedure_sync_clean(df), "h", "db").first()
    assert r["a"] is None and r["b"] == "42" and r["c"] is None and r["SourceHost"] == "h" and r["SourceDB"] == "db"
    assert not math.isnan(0.0)
