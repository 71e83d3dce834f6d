"""Changelogs and collections derived from the given tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BULK = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bulk_of(seq: Column, size: int = BULK) -> Column:
    return F.call_function("div", seq, F.lit(size))


def event_kind() -> Column:
    """Row kind of an event."""
    kind = F.col("event_type")
    return F.when(kind == "signup", "+I").when(kind == "error", "-D").when(kind == "view", "-U").otherwise("+U")


def event_changes(spark: SparkSession, sf_dir: str, bulk: int = BULK) -> DataFrame:
    """Every event as a change of its user's document; not well formed on purpose."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("_key"),
        F.col("event_id").alias("seq"),
        bulk_of(F.col("event_id"), bulk).alias("bulk_id"),
        event_kind().alias("op"),
        F.struct("value", "event_type").alias("doc"),
    )


def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection that holds some of the users' keys and an attribute events lack."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("_key"),
        F.col("s_acctbal").alias("value"),
        F.col("s_name").alias("extra"),
    )


def customer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to write, ``(_key, doc)``; the first ones share keys with the suppliers."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("_key"),
        F.struct(F.col("c_acctbal").alias("value"), F.col("c_mktsegment").alias("segment")).alias("doc"),
    )


# The same in SQL, as common table expressions.
CHANGES_SQL = f"""
ch as (
  select cast(user_id as varchar) as _key, event_id as seq, event_id // {BULK} as bulk_id, value, event_type,
         case event_type when 'signup' then '+I' when 'error' then '-D' when 'view' then '-U' else '+U' end as op
  from events)"""

GROUPS_SQL = """
g as (
  select bulk_id, _key, count(*) as n, max_by({'op': op, 'value': value, 'event_type': event_type}, seq) as l
  from ch group by bulk_id, _key),
groups as (
  select bulk_id, _key, n, l.op as op, l.value as value, l.event_type as event_type from g)"""

NET_SQL = """
net as (
  select *, case when op = '-D' then 'D'
                 when n > 1 and op in ('+I', '+U') then 'U'
                 when op = '+I' then 'I'
                 when op = '+U' then 'R' end as a
  from groups)"""

BASE_SQL = """
base as (
  select cast(s_suppkey as varchar) as _key, s_acctbal as value, cast(null as varchar) as event_type,
         s_name as extra
  from supplier)"""

EMPTY_BASE_SQL = """
base as (
  select cast(null as varchar) as _key, cast(null as double) as value, cast(null as varchar) as event_type,
         cast(null as varchar) as extra
  where false)"""

# Applies the bulks of ``net`` to ``base`` in order, as window functions.
APPLY_SQL = """
u as (
  select _key, bulk_id, {'value': value, 'event_type': event_type} as doc, cast(null as varchar) as extra, a
  from net where a is not null
  union all
  select _key, -1, {'value': value, 'event_type': event_type}, extra, 'B' from base),
w as (
  select *,
    last_value(case when a <> 'R' then a end ignore nulls) over (
      partition by _key order by bulk_id rows between unbounded preceding and 1 preceding) as pa,
    last_value(case when a <> 'R' then a end ignore nulls) over (
      partition by _key order by bulk_id rows between unbounded preceding and current row) as ca
  from u),
e as (
  select *, coalesce(pa, 'D') <> 'D' as pre, coalesce(ca, 'D') <> 'D' as post from w),
applied as (
  select _key,
    max_by(doc, bulk_id) filter (where a in ('U', 'B') or (a = 'R' and pre) or (a = 'I' and not pre)) as doc,
    case when not bool_or(a in ('D', 'R')) then max(extra) end as extra
  from e group by _key having max_by(post, bulk_id)),
result as (
  select _key, doc.value as value, doc.event_type as event_type, extra from applied)"""


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach.

    The cluster names the shared folder in ``spark.checkpoint.dir``. A machine
    of its own (local mode) may use its temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/docsink/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix=f"docsink-{purpose}-")
