"""One small frame per type (E1-E25) and the key rules (K1-K5)."""

import json

import pytest
from pyspark.sql import functions as F

from docsink.functions.encoding import document_json, encode_documents, entries_to_map, multiset_by


def encoded(df, key="id"):
    return encode_documents(df, key).select("_key", "doc.*")


def one(spark, expression, key="id"):
    return encoded(spark.sql(f"select 1 as id, {expression} as x"), key).first()["x"]


def as_json(spark, expression):
    docs = encode_documents(spark.sql(f"select 1 as id, {expression} as x"), "id")
    return json.loads(docs.select(document_json(F.col("doc"), docs.schema["doc"].dataType)).first()[0])["x"]


@pytest.mark.parametrize(
    "expression,value",
    [
        ("null", None),
        ("cast(null as date)", None),
        ("cast(null as binary)", None),
        ("cast(null as decimal(5,2))", None),
        ("cast(null as array<tinyint>)", None),
        ("cast(null as struct<a:int>)", None),
        ("true", True),
        ("cast(-128 as tinyint)", -128),
        ("cast(-32768 as smallint)", -32768),
        ("2147483647", 2147483647),
        ("9223372036854775807L", 9223372036854775807),
        ("cast(0.1 as float)", 0.10000000149011612),
        ("1.5D", 1.5),
        ("'text'", "text"),
        ("interval '1-2' year to month", 14),
        ("interval '-3' year", -36),
        ("interval '7' month", 7),
        ("interval '1 02:03:04.005678' day to second", 93784005),
        ("interval '90' second", 90000),
        ("interval '2' day", 172800000),
        ("interval '-0.0015' second", -1),
        ("date'1969-12-31'", -1),
        ("date'2024-02-29'", 19782),
        ("timestamp_ntz'2024-01-02 03:04:05.678999'", "2024-01-02T03:04:05.678Z"),
        ("timestamp_ntz'1969-12-31 23:59:59.999999'", "1969-12-31T23:59:59.999Z"),
        ("timestamp'2024-01-02 03:04:05'", "2024-01-02T03:04:05.000Z"),
    ],
)
def test_scalars(spark, expression, value):
    assert one(spark, expression) == value


def test_local_timestamp_uses_the_session_zone(spark):
    df = spark.sql("select 1 as id, timestamp'2024-06-01 12:00:00+00:00' as x")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert encoded(df).first()["x"] == "2024-06-01T21:00:00.000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_small_integers_become_int32(spark):
    df = encoded(spark.sql("select 1 as id, 1Y as a, 1S as b, 1L as c, cast(1 as float) as d"))
    assert dict(df.dtypes) == {"_key": "string", "id": "int", "a": "int", "b": "int", "c": "bigint", "d": "double"}


def test_binary(spark):
    assert one(spark, "X'00FF10'").asDict(recursive=True) == {"$binary": {"base64": "AP8Q", "subType": "00"}}
    assert one(spark, "X''").asDict(recursive=True) == {"$binary": {"base64": "", "subType": "00"}}


@pytest.mark.parametrize(
    "value,scale,text",
    [
        ("1.50", 2, "1.50"),
        ("-0.01", 2, "-0.01"),
        ("0.000001", 6, "0.000001"),
        ("0.0000012", 7, "0.0000012"),
        ("0.0000001", 7, "1E-7"),
        ("-0.00000123", 10, "-0.0000012300"),
        ("-0.00000012", 10, "-1.200E-7"),
        ("0", 10, "0E-10"),
        ("12345678.1234567890", 10, "12345678.1234567890"),
    ],
)
def test_decimal_text(spark, value, scale, text):
    assert one(spark, f"cast('{value}' as decimal(20,{scale}))")["$numberDecimal"] == text


def test_decimal_digits_are_limited(spark):
    fits = "1234567890123456789012345678901234"
    assert one(spark, f"cast('{fits}' as decimal(38,0))")["$numberDecimal"] == fits
    assert one(spark, f"cast('{fits}.0000' as decimal(38,4))")["$numberDecimal"] == f"{fits}.0000"
    with pytest.raises(Exception, match="cannot encode field x"):
        one(spark, f"cast('{fits}5' as decimal(38,0))")


def test_arrays_keep_nulls_and_order(spark):
    assert one(spark, "array(3Y, null, 1Y)") == [3, None, 1]
    assert one(spark, "array(array(date'1970-01-02'), null)") == [[1], None]


def test_maps(spark):
    assert one(spark, "map('a', 1Y, 'b', cast(null as tinyint))") == {"a": 1, "b": None}
    assert one(spark, "map('a', map('b', date'1970-01-03'))") == {"a": {"b": 2}}


def test_entries_drop_null_keys_and_keep_the_last(spark):
    df = spark.createDataFrame(
        [([("b", 1), (None, 9), ("a", 2), ("b", None), ("a", 3), ("c", 4)],), ([],), (None,), ([(None, 1)],)],
        "e array<struct<k:string,v:int>>",
    )
    got = [r[0] for r in df.select(entries_to_map(F.col("e"))).collect()]
    assert got == [{"a": 3, "b": None, "c": 4}, {}, None, {}]


def test_multiset_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "c"), (2, None)], "k int, e string")
    got = {r["k"]: r["m"] for r in multiset_by(df, ["k"], "e", "m").collect()}
    assert got == {1: {"a": 2, "b": 1}, 2: {"c": 1}}
    assert dict(multiset_by(df, ["k"], "e", "m").dtypes)["m"] == "map<string,int>"


def test_rows_nest(spark):
    row = one(spark, "named_struct('a', 1Y, 'b', named_struct('c', date'1970-01-02', 'd', null))")
    assert row.asDict(recursive=True) == {"a": 1, "b": {"c": 1, "d": None}}


@pytest.mark.parametrize(
    "expression,path",
    [
        ("map(1, 'a')", "x"),
        ("array(map(1, 'a'))", r"x\[\]"),
        ("named_struct('in', parse_json('1'))", "x.in"),
        ("parse_json('1')", "x"),
        ("make_interval(1, 1)", "x"),
    ],
)
def test_rejected_types_name_the_field(spark, expression, path):
    with pytest.raises(TypeError, match=f"cannot encode field {path}"):
        one(spark, expression)


def test_json_keeps_nulls_and_wraps_odd_doubles(spark):
    assert as_json(spark, "cast('NaN' as double)") == {"$numberDouble": "NaN"}
    assert as_json(spark, "array(1.5D, cast('-Infinity' as double), null)") == [1.5, {"$numberDouble": "-Infinity"}, None]
    assert as_json(spark, "map('a', cast('Infinity' as float))") == {"a": {"$numberDouble": "Infinity"}}
    assert as_json(spark, "named_struct('s', 'NaN', 'd', 2.0D, 'n', null)") == {"s": "NaN", "d": 2.0, "n": None}
    assert as_json(spark, "1.25BD") == {"$numberDecimal": "1.25"}


@pytest.mark.parametrize(
    "expression,key",
    [
        ("5L", "5"),
        ("'abc'", "abc"),
        ("true", "true"),
        ("1.5D", "1.5"),
        ("1e10D", "1.0E10"),
        ("date'1970-01-11'", "10"),
        ("1.50BD", "1.50"),
        ("timestamp_ntz'2024-01-02 03:04:05'", "2024-01-02T03:04:05.000Z"),
    ],
)
def test_key_is_the_text_of_the_encoded_attribute(spark, expression, key):
    assert encode_documents(spark.sql(f"select {expression} as k"), "k").first()["_key"] == key


def test_key_rules(spark):
    df = spark.sql("select 1 as a, 2 as b, 'user' as _key, array(1) as c")
    assert encode_documents(df, ["a", "b"], key_policy="first").first()["_key"] == "1"
    assert "_key" not in encode_documents(df, "a").select("doc.*").columns
    for bad in (["a", "b"], [], None, "missing"):
        with pytest.raises(ValueError):
            encode_documents(df, bad)
    with pytest.raises(ValueError):
        encode_documents(df, "a", key_policy="all")
    with pytest.raises(TypeError):
        encode_documents(df, "c")
    with pytest.raises(Exception, match="null document key"):
        encode_documents(spark.sql("select cast(null as int) as k"), "k").collect()


def test_a_key_column_called_key(spark):
    row = encode_documents(spark.sql("select 'k1' as _key, 2 as v"), "_key").select("_key", "doc.*").first()
    assert row.asDict() == {"_key": "k1", "v": 2}


def test_scan_reads_only_the_columns_of_the_document(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("event_id", "value")
    plan = encode_documents(events, "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    assert "Python" not in plan


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin"])
def test_wall_clocks_ignore_the_session_zone(spark, zone):
    """Also times that the zone skips, or has twice."""
    given = {
        "2024-03-10 02:30:00": "2024-03-10T02:30:00.000Z",
        "2024-03-31 02:30:00.1": "2024-03-31T02:30:00.100Z",
        "2024-11-03 01:30:00.1239": "2024-11-03T01:30:00.123Z",
        "2024-10-27 02:30:00.05": "2024-10-27T02:30:00.050Z",
        "1965-06-01 00:00:00.999999": "1965-06-01T00:00:00.999Z",
        "0001-01-01 00:00:00": "0001-01-01T00:00:00.000Z",
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, want in given.items():
            df = spark.sql(f"select 1 as id, timestamp_ntz'{text}' as t, cast(null as timestamp_ntz) as n")
            assert tuple(encode_documents(df, "id").select("doc.t", "doc.n").first()) == (want, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
