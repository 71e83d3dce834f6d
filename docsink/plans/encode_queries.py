"""Encoding and key queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsink.functions.encoding import (
    decode_json_documents,
    document_json,
    encode_documents,
    entries_to_map,
    multiset_by,
)
from docsink.functions.serializing import Change, serialize_rows
from docsink.options import SinkOptions
from docsink.plans.catalog import query
from docsink.plans.tables import event_kind, table, work_dir
from docsink.streaming.sink import DocumentSink


@query(
    "encode_scalars",
    """
    select cast(o_orderkey as varchar) as _key, o_orderkey, o_orderkey % 2 = 0 as b,
           cast(o_orderkey % 100 as int) as i8, cast(o_orderkey % 30000 as int) as i16,
           cast(o_orderkey as int) as i32, o_orderkey * 1000003 as i64,
           cast(cast(o_totalprice as float) as double) as f, o_totalprice as d, o_orderstatus as s
    from orders""",
)
def encode_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (key % 2 == 0).alias("b"),
        (key % 100).cast("tinyint").alias("i8"),
        (key % 30000).cast("smallint").alias("i16"),
        key.cast("int").alias("i32"),
        (key * 1000003).alias("i64"),
        F.col("o_totalprice").cast("float").alias("f"),
        F.col("o_totalprice").alias("d"),
        F.col("o_orderstatus").alias("s"),
    )
    return encode_documents(rows, "o_orderkey").select("_key", "doc.*")


@query(
    "encode_nulls",
    """
    select _key, n, s, k, cast(to_json({'o_orderkey': o_orderkey, 'n': n, 's': s, 'k': k}) as varchar) as json
    from (select cast(o_orderkey as varchar) as _key, o_orderkey, cast(null as varchar) as n,
                 nullif(o_orderstatus, 'P') as s, nullif(o_custkey, 1) as k from orders)""",
)
def encode_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(None).alias("n"),
        F.nullif("o_orderstatus", F.lit("P")).alias("s"),
        F.nullif("o_custkey", F.lit(1)).alias("k"),
    )
    docs = encode_documents(rows, "o_orderkey")
    return docs.select(
        "_key", "doc.n", "doc.s", "doc.k", document_json(F.col("doc"), docs.schema["doc"].dataType).alias("json")
    )


@query(
    "encode_intervals",
    """
    select cast(l_orderkey as varchar) as _key, l_orderkey,
           cast(l_linenumber * 12 + l_partkey % 12 as int) as ym,
           cast(l_linenumber * 86400000 + cast(l_quantity + l_discount as decimal(18, 6)) * 1000 as bigint) as dt
    from lineitem""",
)
def encode_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.make_ym_interval(F.col("l_linenumber"), (F.col("l_partkey") % 12).cast("int")).alias("ym"),
        F.make_dt_interval(
            F.col("l_linenumber"),
            F.lit(0),
            F.lit(0),
            (F.col("l_quantity") + F.col("l_discount")).cast("decimal(18,6)"),
        ).alias("dt"),
    )
    return encode_documents(rows, "l_orderkey").select("_key", "doc.*")


@query(
    "encode_binary",
    """
    select cast(o_orderkey as varchar) as _key, base64(encode(o_orderpriority)) as base64, '00' as sub_type
    from orders""",
)
def encode_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").cast("binary").alias("bin")
    )
    body = F.col("doc.bin")["$binary"]
    return encode_documents(rows, "o_orderkey").select(
        "_key", body["base64"].alias("base64"), body["subType"].alias("sub_type")
    )


@query(
    "encode_temporal",
    """
    select cast(event_id as varchar) as _key, event_id,
           cast(date_diff('day', date '1970-01-01', cast(ts as date)) as int) as dt,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as wall, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') as instant
    from events""",
)
def encode_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        ts.cast("date").alias("dt"),
        ts.cast("timestamp_ntz").alias("wall"),
        ts.cast("timestamp").alias("instant"),
    )
    return encode_documents(rows, "event_id").select("_key", "doc.*")


@query(
    "encode_decimal",
    """
    select cast(o_orderkey as varchar) as _key, cast(cast(o_totalprice as decimal(12, 2)) as varchar) as price
    from orders""",
)
def encode_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    return encode_documents(rows, "o_orderkey").select(
        "_key", F.col("doc.price")["$numberDecimal"].alias("price")
    )


@query(
    "encode_array",
    """
    select cast(vec_id as varchar) as _key, cast(i - 1 as int) as pos, cast(embedding[i] as double) as x
    from embeddings, unnest(range(1, len(embedding) + 1)) as r(i)""",
)
def encode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return encode_documents(rows, "vec_id").select("_key", F.posexplode("doc.embedding").alias("pos", "x"))


@query(
    "encode_map",
    """
    select cast(event_id as varchar) as _key, 'k' as name, cast(json_extract(props, '$.k') as int) as v
    from events""",
)
def encode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "map<string,smallint>").alias("m")
    )
    return encode_documents(rows, "event_id").select("_key", F.explode("doc.m").alias("name", "v"))


@query(
    "encode_map_entries",
    """
    select cast(event_id as varchar) as _key, event_type as name, event_id as v from events
    union all
    select cast(event_id as varchar), 'user', user_id from events""",
)
def encode_map_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = lambda k, v: F.struct(k.cast("string").alias("k"), v.cast("bigint").alias("v"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        entries_to_map(
            F.array(
                entry(F.col("event_type"), F.lit(-1)),
                entry(F.lit("user"), F.col("user_id")),
                entry(F.lit(None), F.lit(-2)),
                entry(F.col("event_type"), F.col("event_id")),
            )
        ).alias("m"),
    )
    return encode_documents(rows, "event_id").select("_key", F.explode("doc.m").alias("name", "v"))


@query(
    "encode_multiset",
    """
    select cast(user_id as varchar) as _key, event_type as element, cast(count(*) as int) as n
    from events group by user_id, event_type""",
)
def encode_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = multiset_by(table(spark, sf_dir, "events"), ["user_id"], "event_type", "kinds")
    return encode_documents(rows, "user_id").select("_key", F.explode("doc.kinds").alias("element", "n"))


@query(
    "encode_nested",
    """
    select cast(o_orderkey as varchar) as _key, o_orderkey, o_orderstatus as status,
           cast(cast(o_totalprice as float) as double) as price,
           cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as int) as day
    from orders""",
)
def encode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(
                F.col("o_totalprice").cast("float").alias("price"), F.col("o_orderdate").cast("date").alias("day")
            ).alias("detail"),
        ).alias("r"),
    )
    return encode_documents(rows, "o_orderkey").select(
        "_key", "doc.o_orderkey", "doc.r.status", "doc.r.detail.price", "doc.r.detail.day"
    )


@query(
    "encode_documents",
    """
    select cast(doc_id as varchar) as _key, '+I' as op, doc_id as seq, doc_id, text, lang, source, n_chars
    from documents""",
)
def encode_whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").withColumns({"op": F.lit("+I"), "seq": F.col("doc_id")})
    return encode_documents(rows, "doc_id").select("_key", "op", "seq", "doc.*")


@query(
    "encode_json_text",
    """
    select cast(event_id as varchar) as _key, event_id as seq,
           case event_type when 'signup' then '+I' when 'error' then '-D' when 'view' then '-U' else '+U' end as op,
           cast(json_extract(props, '$.k') as int) as k
    from events""",
)
def encode_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_key"),
        F.col("event_id").alias("seq"),
        event_kind().alias("op"),
        decode_json_documents(F.col("props"), "k int")["k"].alias("k"),
    )


@query(
    "custom_encoder",
    """
    select conv_id as _key, max_by({'r': role, 't': text}, turn).r as role, max_by({'r': role, 't': text}, turn).t as text
    from (select 'conv-' || conv_id as conv_id, turn, role, text from conversations) group by conv_id""",
)
def custom_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    def encoder(rows: DataFrame) -> DataFrame:
        """The latest message of every conversation."""
        return rows.select(
            F.concat(F.lit("conv-"), F.col("conv_id").cast("string")).alias("_key"),
            F.when(F.col("turn") == 0, "+I").otherwise("+U").alias("op"),
            F.col("turn").alias("seq"),
            F.struct("role", "text").alias("doc"),
        )

    options = SinkOptions("chats", "latest", key="conv_id", mode="lww")
    sink = DocumentSink(spark, work_dir(spark, "custom"), options, encoder=encoder)
    sink.write(table(spark, sf_dir, "conversations"))
    return sink.read()


@query(
    "derive_key",
    """
    select 'bigint' as kind, cast(o_orderkey as varchar) as _key, o_orderkey from orders
    union all
    select 'date', cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as varchar), o_orderkey from orders
    union all
    select 'decimal', cast(cast(o_totalprice as decimal(12, 2)) as varchar), o_orderkey from orders
    union all
    select 'string', o_orderpriority, o_orderkey from orders""",
)
def derive_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    parts = [
        ("bigint", key),
        ("date", F.col("o_orderdate").cast("date")),
        ("decimal", F.col("o_totalprice").cast("decimal(12,2)")),
        ("string", F.col("o_orderpriority")),
    ]
    keyed = [
        encode_documents(orders.select(key, part.alias("k")), "k").select(
            F.lit(kind).alias("kind"), "_key", "doc.o_orderkey"
        )
        for kind, part in parts
    ]
    return keyed[0].unionByName(keyed[1]).unionByName(keyed[2]).unionByName(keyed[3])


@query(
    "derive_key_composite_first",
    "select cast(l_orderkey as varchar) as _key, l_orderkey, l_linenumber from lineitem",
)
def derive_key_composite_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return encode_documents(rows, ["l_orderkey", "l_linenumber"], key_policy="first").select("_key", "doc.*")


@query("derive_key_overwrites", "select cast(o_orderkey as varchar) as _key, o_orderkey, o_custkey from orders")
def derive_key_overwrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("_key"))
    return encode_documents(rows, "o_orderkey").select("_key", "doc.*")


@query(
    "serialize_rows",
    """
    select cast(o_orderkey as varchar) as _key, case when o_orderstatus = 'F' then '-D' else '+I' end as op,
           o_orderkey as seq, o_orderkey, o_custkey, o_totalprice, o_orderpriority
    from orders where o_orderstatus <> 'P'""",
)
def serialize_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents made by a Python function, one row at a time."""

    def serializer(row: dict) -> Change | None:
        if row["o_orderstatus"] == "P":
            return None
        names = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
        return Change(str(row["o_orderkey"]), {n: row[n] for n in names}, "-D" if row["o_orderstatus"] == "F" else "+I")

    orders = table(spark, sf_dir, "orders")
    columns = orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    document = columns.drop("o_orderstatus").schema
    found = serialize_rows(columns.withColumn("seq", F.col("o_orderkey")), serializer, document)
    return found.where("error is null").select("_key", "op", "seq", "doc.*")
