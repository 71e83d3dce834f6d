"""Queries that apply changes to a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsink.operators import applying
from docsink.operators.changelog import normalize_changelog
from docsink.operators.effects import fold_bulks
from docsink.operators.outcomes import fold_outcomes, resolve_outcomes
from docsink.options import SinkOptions
from docsink.plans.catalog import query
from docsink.plans.tables import (
    APPLY_SQL,
    BASE_SQL,
    CHANGES_SQL,
    EMPTY_BASE_SQL,
    GROUPS_SQL,
    NET_SQL,
    customer_documents,
    event_changes,
    event_kind,
    supplier_documents,
    table,
    work_dir,
)
from docsink.sources.collection import Collection
from docsink.streaming.sink import DocumentSink

_SUPPLIERS = "(select cast(s_suppkey as varchar) as _key, s_acctbal as value, s_name as extra from supplier)"
_CUSTOMERS = "(select cast(c_custkey as varchar) as _key, c_acctbal as value, c_mktsegment as segment from customer)"


@query(
    "apply_changelog_bulk",
    f"with {CHANGES_SQL}, {GROUPS_SQL}, {NET_SQL}, {BASE_SQL}, {APPLY_SQL} select * from result",
)
def apply_changelog_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A bulk holds at most BULK changes, so no (key, segment) can be large.
    return applying.apply_bulks(supplier_documents(spark, sf_dir), event_changes(spark, sf_dir), bounded_bulks=True)


@query(
    "apply_changelog_large_bulks",
    f"""
    with {CHANGES_SQL.replace("// 100", "// 2500")}, {GROUPS_SQL}, {NET_SQL}, {BASE_SQL}, {APPLY_SQL}
    select * from result""",
)
def apply_changelog_large_bulks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulks of any size: changes of a key are combined before they are shuffled."""
    return applying.apply_bulks(
        supplier_documents(spark, sf_dir), event_changes(spark, sf_dir, bulk=2500)
    )


@query(
    "apply_changelog_many_bulks",
    f"""
    with {CHANGES_SQL.replace("// 100", "// 10")}, {GROUPS_SQL}, {NET_SQL}, {BASE_SQL}, {APPLY_SQL}
    select * from result""",
)
def apply_changelog_many_bulks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulks of ten changes, so that a key's bulks lie in several segments and groups of them."""
    effects = fold_bulks(event_changes(spark, sf_dir, bulk=10), segment_bulks=64, bounded_bulks=True, levels=1)
    base = supplier_documents(spark, sf_dir)
    doc_type = event_changes(spark, sf_dir).schema["doc"].dataType
    return applying.apply_effects(base, effects, doc_type)


@query(
    "apply_changelog_lww",
    f"""
    with {CHANGES_SQL}, {BASE_SQL},
    last as (
      select _key, max_by({{'op': op, 'value': value, 'event_type': event_type}}, seq) as l
      from ch where op <> '-U' group by _key)
    select _key, l.value as value, l.event_type as event_type, cast(null as varchar) as extra
    from last where l.op <> '-D'
    union all
    select _key, value, event_type, extra from base where _key not in (select _key from last)""",
)
def apply_changelog_lww(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = normalize_changelog(event_changes(spark, sf_dir))
    return applying.apply_last_writes(supplier_documents(spark, sf_dir), changes)


@query(
    "apply_deletes",
    f"""
    select _key, value, segment from {_CUSTOMERS}
    where _key not in (select cast(user_id as varchar) from events where event_type = 'error')""",
)
def apply_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    keys = events.select(F.col("user_id").cast("string").alias("_key"))
    base = customer_documents(spark, sf_dir).select("_key", "doc.*")
    return applying.apply_deletes(base, keys)


@query(
    "apply_inserts",
    f"""
    select _key, value, extra, cast(null as varchar) as segment from {_SUPPLIERS}
    union all
    select _key, value, null, segment from {_CUSTOMERS} where _key not in (select _key from {_SUPPLIERS})""",
)
def apply_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applying.apply_inserts(supplier_documents(spark, sf_dir), customer_documents(spark, sf_dir))


@query(
    "apply_replaces",
    f"""
    select s._key, case when c._key is null then s.value else c.value end as value, c.segment as segment,
           case when c._key is null then s.extra end as extra
    from {_SUPPLIERS} s left join {_CUSTOMERS} c on s._key = c._key""",
)
def apply_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applying.apply_replaces(supplier_documents(spark, sf_dir), customer_documents(spark, sf_dir))


@query(
    "apply_upserts",
    f"""
    select coalesce(c._key, s._key) as _key, case when c._key is null then s.value else c.value end as value,
           c.segment as segment, s.extra as extra
    from {_SUPPLIERS} s full join {_CUSTOMERS} c on s._key = c._key""",
)
def apply_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applying.apply_upserts(supplier_documents(spark, sf_dir), customer_documents(spark, sf_dir))


@query(
    "apply_one_bulk",
    f"""
    with {CHANGES_SQL.replace("ch as", "ev as")},
    ch as (
      select _key, seq, 0 as bulk_id, value, event_type, op from ev
      union all
      select cast(c_custkey as varchar), -1 - c_custkey, 0, c_acctbal, c_mktsegment,
             case c_mktsegment when 'BUILDING' then '+I' when 'MACHINERY' then '-D' when 'HOUSEHOLD' then '-U'
                               else '+U' end
      from customer),
    {GROUPS_SQL}, {NET_SQL},
    base as (
      select cast(doc_id as varchar) as _key, cast(quality as double) as value,
             cast(null as varchar) as event_type, cast(toxic as varchar) as extra
      from labels),
    {APPLY_SQL} select * from result""",
)
def apply_one_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    singles = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_key"),
        (-1 - F.col("c_custkey")).alias("seq"),
        F.when(segment == "BUILDING", "+I")
        .when(segment == "MACHINERY", "-D")
        .when(segment == "HOUSEHOLD", "-U")
        .otherwise("+U")
        .alias("op"),
        F.struct(F.col("c_acctbal").alias("value"), segment.alias("event_type")).alias("doc"),
    )
    base = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("_key"),
        F.col("quality").cast("double").alias("value"),
        F.col("toxic").cast("string").alias("extra"),
    )
    return applying.apply_one_bulk(base, singles.unionByName(event_changes(spark, sf_dir).drop("bulk_id")))


@query(
    "apply_upserts_nested_merge",
    f"""
    select coalesce(c._key, s._key) as _key, case when c._key is null then s.value else c.value end as balance,
           s.extra as name, c.segment as segment
    from {_SUPPLIERS} s full join {_CUSTOMERS} c on s._key = c._key""",
)
def apply_upserts_nested_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested object with other fields on either side is merged field by field."""
    base = supplier_documents(spark, sf_dir).select(
        "_key", F.struct(F.col("value").alias("balance"), F.col("extra").alias("name")).alias("account")
    )
    docs = customer_documents(spark, sf_dir).select(
        "_key", F.struct(F.struct(F.col("doc.value").alias("balance"), "doc.segment").alias("account")).alias("doc")
    )
    return applying.apply_upserts(base, docs).select("_key", "account.*")


_MAP_MERGE_SQL = f"""
    with {CHANGES_SQL}, {GROUPS_SQL}, {NET_SQL},
    u as (
      select _key, bulk_id, event_type as name, value as v, a from net where a is not null
      union all
      select cast(s_suppkey as varchar), -1, 'base', s_acctbal, 'B' from supplier),
    w as (
      select *,
        last_value(case when a <> 'R' then a end ignore nulls) over (
          partition by _key order by bulk_id rows between unbounded preceding and 1 preceding) as pa,
        last_value(case when a <> 'R' then a end ignore nulls) over (
          partition by _key order by bulk_id rows between unbounded preceding and current row) as ca
      from u),
    e as (
      select *, coalesce(pa, 'D') <> 'D' as pre, coalesce(ca, 'D') <> 'D' as post from w),
    k as (
      select _key,
        max(bulk_id) filter (where a in ('B', 'R') and (a = 'B' or pre) or a in ('I', 'U') and not pre) as start
      from e group by _key having max_by(post, bulk_id)),
    written as (
      select e._key, name, v, bulk_id from e join k using (_key)
      where bulk_id >= start and (a in ('U', 'B') or (a = 'R' and pre) or (a = 'I' and not pre)))
    select _key, name, max_by(v, bulk_id) as v from written group by _key, name"""


@query("apply_upserts_map_merge", _MAP_MERGE_SQL)
def apply_upserts_map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _map_merge(spark, sf_dir, 100)


@query("apply_upserts_map_merge_many_bulks", _MAP_MERGE_SQL.replace("// 100", "// 10"))
def apply_upserts_map_merge_many_bulks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merging over several segments and groups."""
    return _map_merge(spark, sf_dir, 10)


def _map_merge(spark: SparkSession, sf_dir: str, bulk: int) -> DataFrame:
    changes = event_changes(spark, sf_dir, bulk).withColumn(
        "doc", F.struct(F.create_map("doc.event_type", "doc.value").alias("m"))
    )
    base = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("_key"), F.create_map(F.lit("base"), "s_acctbal").alias("m")
    )
    return applying.apply_bulks(base, changes, bounded_bulks=True).select("_key", F.explode("m").alias("name", "v"))


@query(
    "apply_into_new_collection",
    f"""
    with {CHANGES_SQL.replace("ch as", "raw as")},
    ch as (
      select _key, seq, (row_number() over (order by seq) - 1) // 1000 as bulk_id, value, event_type, op
      from raw where op <> '-U'),
    {GROUPS_SQL}, {NET_SQL}, {EMPTY_BASE_SQL}, {APPLY_SQL}
    select _key, cast(_key as bigint) as user_id, value, event_type from result""",
)
def apply_into_new_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row encoding, bulks of the default size and a collection that does not exist yet."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", "value", "event_type", F.col("event_id").alias("seq"), event_kind().alias("op")
    )
    sink = DocumentSink(spark, work_dir(spark, "new"), SinkOptions("shop", "users", key="user_id"))
    sink.write(rows)
    return sink.read()


@query(
    "scan_collection_with_log",
    """
    select cast(o_orderkey as varchar) as _key, o_custkey,
           case when o_orderkey % 3 <> 0 and o_orderkey % 5 <> 0 then o_orderstatus end as o_orderstatus,
           case when o_orderkey % 3 = 0 and o_orderkey % 5 <> 0 then o_orderpriority end as note,
           case when o_orderkey % 5 = 0 then 1 end as flag
    from orders where o_orderkey % 10 <> 0""",
)
def scan_collection_with_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bucketed base, and a log of two document types that is not broadcast."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    collection = Collection(spark, f"{work_dir(spark, 'log')}/shop/orders", buckets=4, broadcast_limit=0)
    collection.create(orders.select(key.cast("string").alias("_key"), "o_custkey", "o_orderstatus"))
    noted = F.struct("o_custkey", F.col("o_orderpriority").alias("note"))
    flagged = F.struct("o_custkey", F.lit(1).alias("flag"))
    for rows, op, doc in (
        (orders.where(key % 3 == 0), F.lit("+U"), noted),
        (orders.where(key % 5 == 0), F.when(key % 2 == 0, "-D").otherwise("+U"), flagged),
    ):
        changes = rows.select(
            key.cast("string").alias("_key"), key.alias("seq"), F.lit(0).alias("bulk_id"), op.alias("op"), doc.alias("doc")
        )
        collection.append(fold_bulks(changes), changes.schema["doc"].dataType)
    return collection.read()


@query(
    "scan_collection",
    "select cast(o_orderkey as varchar) as _key, o_custkey, o_orderstatus, o_totalprice from orders",
)
def scan_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("_key"), "o_custkey", "o_orderstatus", "o_totalprice"
    )
    collection = Collection(spark, f"{work_dir(spark, 'scan')}/shop/orders")
    collection.create(documents)
    return collection.read()


@query(
    "scan_collection_by_key",
    """
    select 'range' as asked, cast(o_orderkey as varchar) as _key, o_custkey, if(o_orderkey % 3 = 0, 'seen', null) as note
    from orders where cast(o_orderkey as varchar) between '17' and '4' and o_orderkey % 6 <> 3
    union all
    select 'keys', cast(o_orderkey as varchar), o_custkey, if(o_orderkey % 3 = 0, 'seen', null)
    from orders where o_orderkey in (1, 2, 3, 6, 35, 420, 600000) and o_orderkey % 6 <> 3""",
)
def scan_collection_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of keys and a few single ones, out of a base and a log of all orders."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    collection = Collection(spark, f"{work_dir(spark, 'keys')}/shop/orders")
    collection.create(orders.select(key.cast("string").alias("_key"), "o_custkey"))
    doc = F.struct("o_custkey", F.lit("seen").alias("note"))
    changes = orders.where(key % 3 == 0).select(
        key.cast("string").alias("_key"),
        key.alias("seq"),
        F.lit(0).alias("bulk_id"),
        F.when(key % 6 == 3, "-D").otherwise("+U").alias("op"),
        doc.alias("doc"),
    )
    collection.append(fold_bulks(changes), changes.schema["doc"].dataType)
    between = collection.read(low="17", high="4").select(F.lit("range").alias("asked"), "*")
    some = collection.read(keys=["1", "2", "3", "6", "35", "420", "600000", "none"])
    return between.unionByName(some.select(F.lit("keys").alias("asked"), "*"))


@query(
    "change_outcomes",
    f"""
    with {CHANGES_SQL}, {GROUPS_SQL}, {NET_SQL}, {BASE_SQL},
    u as (
      select _key, bulk_id, a from net where a is not null
      union all select _key, -1, 'B' from base),
    w as (
      select *, coalesce(last_value(case when a in ('I', 'U', 'B') then true when a = 'D' then false end ignore nulls) over (
          partition by _key order by bulk_id rows between unbounded preceding and 1 preceding), false) as was
      from u)
    select _key, count(*) filter (a = 'I') as inserts, count(*) filter (a = 'R') as replaces,
           count(*) filter (a = 'U') as upserts, count(*) filter (a = 'D') as deletes,
           count(*) filter (a = 'I' and was) as inserts_refused, count(*) filter (a = 'R' and not was) as replaces_refused,
           count(*) filter (a = 'D' and not was) as deletes_missed,
           max_by(case when a in ('I', 'U', 'B') then true when a = 'D' then false else was end, bulk_id) as present
    from w group by _key having count(*) filter (a <> 'B') > 0""",
)
def change_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many changes of each key an existing collection takes, and how many it refuses."""
    return resolve_outcomes(fold_outcomes(event_changes(spark, sf_dir)), supplier_documents(spark, sf_dir))
