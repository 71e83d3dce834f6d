"""A Python serializer, against the built-in encoding, and rows it cannot take."""

import json

import pytest
from pyspark.sql import functions as F

from docsink import Change, DocumentSink, SinkOptions, encode_documents, row_encoder, serialize_rows
from tests.test_sink import by_hand, changelog, held, rows


def same_as_built_in(row):
    return Change(str(row["id"]), {"id": row["id"], "v": row["v"], "tags": row["tags"], "m": row["m"]}, row["op"])


def test_equals_the_built_in_encoding(spark):
    frame = spark.sql("""
        select id, id * 2 as seq, if(id % 2 = 0, '+I', '-D') as op, if(id % 5 = 0, null, id / 4) as v,
               array(cast(id as string), null) as tags, map('k', struct(id as x)) as m
        from range(200)""")
    built_in = encode_documents(frame, "id").select("_key", "op", "seq", "doc")
    document = built_in.schema["doc"].dataType
    got = serialize_rows(frame, same_as_built_in, document)
    assert got.where("error is not null").count() == 0
    got = got.select("_key", "op", "seq", "doc")
    assert sorted(map(str, got.collect())) == sorted(map(str, built_in.collect()))


def picky(row):
    if row["id"] == 3:
        raise KeyError("three")
    if row["id"] == 4:
        return None
    value = {5: "text", 6: None}.get(row["id"], row["v"])
    more = {"extra": 1} if row["id"] == 7 else {}
    return Change(str(row["id"]), {"id": row["id"], "v": value, **more})


def test_failed_rows_come_back_with_their_reason(spark):
    frame = spark.range(2, 9).selectExpr("cast(id as int) as id", "id as seq", "id * 1.5D as v")
    found = {r["seq"]: r for r in serialize_rows(frame, picky, "id int, v double").collect()}
    assert sorted(found) == [2, 3, 5, 6, 7, 8]
    assert {s for s, r in found.items() if r["error"] is None} == {2, 6, 8}
    assert "KeyError" in found[3]["error"] and "extra" in found[7]["error"] and found[5]["error"]
    assert all(json.loads(found[s]["row"])["id"] == s and found[s]["doc"] is None for s in (3, 5, 7))
    assert found[6]["doc"]["v"] is None and found[8]["doc"]["v"] == 12.0


def test_as_encoder_of_a_sink(spark, tmp_path):
    def serializer(row):
        return Change(str(row["id"]), {"id": row["id"], "v": row["v"]}, row["op"])

    options = SinkOptions("db", "docs", key="id", flush_size=13)
    data = changelog(80, seed=4)
    sink = DocumentSink(spark, str(tmp_path), options, encoder=row_encoder(serializer, "id int, v double"))
    sink.write(rows(spark, data))
    assert held(sink.read()) == by_hand([data], 13)
    with pytest.raises(Exception, match="row cannot be serialized: ZeroDivisionError"):
        failing = row_encoder(lambda row: Change("x", {"v": 1 / 0}), "v double")
        DocumentSink(spark, str(tmp_path / "b"), options, encoder=failing).write(rows(spark, data))
    assert serialize_rows(rows(spark, data).where(F.lit(False)), serializer, "id int, v double").collect() == []
