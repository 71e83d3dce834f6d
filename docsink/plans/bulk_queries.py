"""Changelog, rolling and bulk queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsink.operators import bulks
from docsink.operators.changelog import normalize_changelog
from docsink.operators.rolling import SEQ_CHUNK, roll_bulks, roll_by_interval
from docsink.plans.catalog import query
from docsink.plans.tables import BULK, CHANGES_SQL, GROUPS_SQL, NET_SQL, event_changes, table

SIX_HOURS = 6 * 3600

_GROUPED = f"with {CHANGES_SQL}, {GROUPS_SQL}"
_NETTED = f"with {CHANGES_SQL}, {GROUPS_SQL}, {NET_SQL}"
_DOC = "value, event_type"


def _flat(groups: DataFrame, *columns: str) -> DataFrame:
    return groups.select("bulk_id", "_key", *columns, "doc.*")


@query("normalize_changelog", f"with {CHANGES_SQL} select _key, seq, bulk_id, op, {_DOC} from ch where op <> '-U'")
def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_changelog(event_changes(spark, sf_dir)).select("_key", "seq", "bulk_id", "op", "doc.*")


@query(
    "roll_bulks_size",
    f"""
    select event_id, user_id % 4 as writer,
           (row_number() over (partition by user_id % 4 order by event_id) - 1) // {BULK} as bulk_id
    from events""",
)
def roll_bulks_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 4).alias("writer"))
    return roll_bulks(rows, BULK, seq="event_id", seq_chunk=SEQ_CHUNK)


@query(
    "roll_bulks_interval",
    f"select event_id, cast(floor(epoch(ts) / {SIX_HOURS}) as bigint) as bulk_id from events",
)
def roll_bulks_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return roll_by_interval(rows, SIX_HOURS * 1000).select("event_id", "bulk_id")


@query(
    "roll_bulks_size_or_interval",
    f"""
    with t as (
      select event_id, user_id % 4 as writer, cast(floor(epoch(ts) / {SIX_HOURS}) as bigint) as tick from events),
    r as (
      select *, (row_number() over (partition by writer, tick order by event_id) - 1) // 10 as cut from t),
    per_tick as (select writer, tick, max(cut) + 1 as n from r group by writer, tick),
    starts as (select writer, tick, sum(n) over (partition by writer order by tick) - n as first from per_tick)
    select event_id, writer, cast(first + cut as bigint) as bulk_id from r join starts using (writer, tick)""",
)
def roll_bulks_size_or_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") % 4).alias("writer"))
    rolled = roll_bulks(rows, 10, seq="event_id", interval_ms=SIX_HOURS * 1000, seq_chunk=SEQ_CHUNK)
    return rolled.select("event_id", "writer", "bulk_id")


@query(
    "bulk_sizes",
    f"with {CHANGES_SQL} select bulk_id, count(*) as n, count(*) >= {BULK} as is_full from ch group by bulk_id",
)
def bulk_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulks.bulk_sizes(event_changes(spark, sf_dir), BULK)


@query("bulk_groups", f"{_GROUPED} select bulk_id, _key, n, op, {_DOC} from groups")
def bulk_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_groups(event_changes(spark, sf_dir)), "n", "op")


@query("bulk_singles", f"{_GROUPED} select bulk_id, _key, op, {_DOC} from groups where n = 1")
def bulk_singles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_singles(bulks.bulk_groups(event_changes(spark, sf_dir))), "op")


@query("bulk_groups_ending", f"{_GROUPED} select bulk_id, _key, n, {_DOC} from groups where n > 1 and op = '+I'")
def bulk_groups_ending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_groups_ending(bulks.bulk_groups(event_changes(spark, sf_dir)), "+I"), "n")


@query("bulk_inserts", f"{_NETTED} select bulk_id, _key, {_DOC} from net where a = 'I'")
def bulk_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_inserts(bulks.bulk_groups(event_changes(spark, sf_dir))))


@query("bulk_updates", f"{_NETTED} select bulk_id, _key, {_DOC} from net where a = 'R'")
def bulk_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_updates(bulks.bulk_groups(event_changes(spark, sf_dir))))


@query("bulk_deletes", f"{_NETTED} select bulk_id, _key from net where a = 'D'")
def bulk_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulks.bulk_deletes(bulks.bulk_groups(event_changes(spark, sf_dir))).select("bulk_id", "_key")


@query("bulk_upserts", f"{_NETTED} select bulk_id, _key, {_DOC} from net where a = 'U'")
def bulk_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.bulk_upserts(bulks.bulk_groups(event_changes(spark, sf_dir))))


@query("bulk_dropped", f"{_NETTED} select bulk_id, _key, n, op from net where a is null")
def bulk_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = bulks.bulk_groups(event_changes(spark, sf_dir))
    return bulks.bulk_dropped(groups).select("bulk_id", "_key", "n", "op")


@query("bulk_net_actions", f"{_NETTED} select bulk_id, _key, a as action, {_DOC} from net where a is not null")
def bulk_net_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(bulks.net_actions(bulks.bulk_groups(event_changes(spark, sf_dir))), "action")
