"""Prefix trie of conversations from padded turn-id matrices (operator 13).

Each distinct sequence of first ``d`` turns of a conversation is a node of depth
``d``. A turn is told by the MD5 of its role and text, so a conversation is a
row of 16-byte ids. Spark sorts these rows by range into shards; a group of equal
conversations may lie in several shards, as ``conv_id`` is part of the order.

In a shard the ids become a matrix, padded with -1, that ``numpy.lexsort``
orders; columns are taken ``COLUMNS`` at a time, and only for rows that are
still equal, so a few long conversations do not widen it for all. Comparing each
row with the one before gives a mask of changed columns, and OR-accumulating it
along the row marks where new nodes start: a row starts the nodes deeper than
what it has in common with the row before. At every depth ``reduceat`` over
these starts adds up the nodes. All figures but the digest are sums over rows:

* a node's children are the nodes that its rows start one column further;
* a row ends a leaf if the next row does not go on from it;
* a row saves, below depth ``d``, the turns that it has in common with the row
  before from ``d`` on, as all others start nodes.

A row at the edge of a shard is compared with its neighbour in the next one, so
the sums of shards are exact. Only nodes that reach over an edge (at most one
path per edge) go through a second aggregation by key, and their parents and
children are named from its result; all others are complete in their shard.

Defined results: a row without ``conv_id`` belongs to no conversation and is
left out; null role or text is empty; turns of the same number are ordered by
the digest of role and text, repeated rows are turns of their own; an empty
table has no nodes, not even a root; further columns are not read. One row holds
a conversation, at 24 bytes a turn. ``ends_sha256`` is defined on one string, so
the ids of equal conversations meet in one value.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import join_groups, text_of, written

SHARD_TURNS = 200_000  # about, in a shard
COLUMNS = 32  # of a matrix at a time
HEAD_TURNS = 6  # shared turns of a hundred conversations are fewer than this
HUNDRED = 100

_NO_ENDS = hashlib.sha256(b"").hexdigest()
_ROOT = b""

_SHARD_NODES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("shard", pa.int32()),
        ("ends", pa.string()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
    ]
)
_SQL_TYPES = {"int64": "long", "int32": "int", "string": "string", "binary": "binary"}
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, ``(turn, id, chars)``."""
    role, text = text_of("role"), text_of("text")
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col("turn").alias("turn"), digest.alias("id"), F.length(text).alias("chars"))
    rows = conversations.where(F.col("conv_id").isNotNull())
    return rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )


def with_shared_heads(sequences: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of the first one of their hundred.

    The first ``crc32(conv_id) % 6`` turns come from the conversation with the
    next smaller round number, if there is one; the others are their own.
    """
    head_id = F.col("conv_id") - F.col("conv_id") % HUNDRED
    heads = sequences.where(F.col("conv_id") % HUNDRED == 0).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, HEAD_TURNS - 1).alias("_turns")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD_TURNS).cast("int")
    joined = sequences.withColumn("_head", head_id).withColumn("_shared", shared).join(heads, "_head", "left")
    none = F.array().cast(joined.schema["turns"].dataType)
    first = F.coalesce(F.slice("_turns", F.lit(1), F.col("_shared")), none)
    own = F.slice("turns", F.col("_shared") + 1, F.size("turns") + 1)
    return joined.select("conv_id", F.concat(first, own).alias("turns"))


def _sorted_rows(ids: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ragged rows, and how many columns each has in common with the one before."""
    length = np.diff(offset)
    n = len(length)
    order, common = np.arange(n), np.zeros(n, np.int64)
    same = np.arange(n) > 0  # as the row before, as far as compared
    begin = 0
    while True:
        group = np.cumsum(~same) - 1
        left = length[order] - begin
        several = (np.bincount(group) > 1) & (np.maximum.reduceat(left, np.flatnonzero(~same)) > 0)
        todo = np.flatnonzero(several[group])
        if not len(todo):
            return order, common
        rows, of = order[todo], group[todo]
        width = np.clip(left[todo], 0, COLUMNS)
        filled = np.arange(COLUMNS) < width[:, None]
        matrix = np.full(filled.shape, -1, np.int32)
        matrix[filled] = ids[(offset[rows] + begin)[:, None] + np.arange(COLUMNS)][filled]
        sort = np.lexsort((*matrix.T[::-1], of))
        rows, matrix = rows[sort], matrix[sort]
        order[todo] = rows
        changed = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
        inside = of[1:] == of[:-1]
        equal = np.minimum(begin + COLUMNS - changed.sum(axis=1), length[rows[1:]])
        at = todo[1:]
        common[at[inside]] = equal[inside]
        same[at[inside]] = ~changed[inside, -1]
        begin += COLUMNS


def _path_keys(ids: np.ndarray, depth: int) -> list[bytes]:
    """Keys of the nodes of a path, down to ``depth``."""
    keys = [_ROOT]
    for d in range(depth):
        keys.append(hashlib.blake2b(keys[-1] + ids[d].tobytes(), digest_size=16).digest())
    return keys


def _shard_nodes(shard: pa.Table) -> pa.Table:
    """Nodes of a shard; those that reach over its edges have a key and are partial."""
    shard = shard.combine_chunks().sort_by("conv_id")
    conv_id = shard["conv_id"].to_numpy()
    lists = shard["ids"].chunk(0)
    offset = lists.offsets.to_numpy().astype(np.int64)
    offset -= offset[0]
    flat = lists.flatten()
    raw = np.frombuffer(b"".join(flat.to_pylist()), ">u8").reshape(-1, 2)
    chars = shard["chars"].chunk(0).flatten().to_numpy().astype(np.int64)
    before, after = shard["before"][0].as_py(), shard["after"][0].as_py()

    # Small numbers in the order of the ids.
    by_id = np.lexsort((raw[:, 1], raw[:, 0]))
    new = np.ones(len(by_id), bool)
    new[1:] = (raw[by_id[1:]] != raw[by_id[:-1]]).any(axis=1)
    ids = np.empty(len(by_id) + COLUMNS, np.int32)  # some more, so that whole matrix rows can be read
    ids[by_id] = np.cumsum(new) - 1

    order, common = _sorted_rows(ids, offset)
    length = np.diff(offset)[order]
    common[0] = before
    following = np.append(common[1:], after)
    ends_leaf = (following < length).astype(np.int64)
    member, begin = conv_id[order], offset[order]
    upto = np.concatenate([[0], np.cumsum(chars)])
    shared_chars = upto[begin + np.maximum(common, 0)]

    first_keys = _path_keys(raw[begin[0] :], before)
    last_keys = _path_keys(raw[begin[-1] :], after)
    parts: list[pa.RecordBatch] = []
    active = np.arange(len(member))
    above = None  # of the depth above: node of each row, smallest members, keys
    depth = 0
    while True:
        active = active[length[active] >= depth]
        if not len(active):
            break
        starts = common[active] < depth
        starts[0] = True
        at = np.flatnonzero(starts)
        nodes = len(at)
        smallest = np.minimum.reduceat(member[active], at)
        saved = shared_chars[active] - upto[begin[active] + max(depth - 1, 0)]
        goes_on = (length[active] > depth) & (common[active] <= depth)
        keys: list[bytes | None] = [None] * nodes
        if depth <= before:
            keys[0] = first_keys[depth]
        if depth <= after:
            keys[-1] = last_keys[depth]

        ends = [""] * nodes
        digests: list[str | None] = [_NO_ENDS] * nodes
        last = np.flatnonzero(length[active] == depth)
        if len(last):
            node = np.cumsum(starts)[last] - 1
            cut = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            names = member[active[last]].astype(str).tolist()
            for i, a, b in zip(node[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(last)], strict=True):
                ends[i] = ",".join(names[a:b])
                digests[i] = hashlib.sha256(ends[i].encode()).hexdigest()
        parents: list[int | None] = [None] * nodes
        parent_keys: list[bytes | None] = [None] * nodes
        if above is not None:
            row_node, names_above, keys_above = above
            up = row_node[active[at]].tolist()
            parents = [None if keys_above[u] is not None else names_above[u] for u in up]
            parent_keys = [keys_above[u] for u in up]
        parts.append(
            pa.record_batch(
                [
                    pa.array(smallest, pa.int64()),
                    pa.array(np.full(nodes, depth), pa.int64()),
                    pa.array(parents, pa.int64()),
                    pa.array(np.diff(np.append(at, len(active))), pa.int64()),
                    pa.array(np.add.reduceat(goes_on.astype(np.int64), at), pa.int64()),
                    pa.array(np.add.reduceat(ends_leaf[active], at), pa.int64()),
                    pa.array(np.add.reduceat(np.where(common[active] >= max(depth, 1), saved, 0), at), pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(np.full(nodes, shard["shard"][0].as_py()), pa.int32()),
                    pa.array([None if k is None else e for k, e in zip(keys, ends, strict=True)], pa.string()),
                    pa.array(keys, pa.binary()),
                    pa.array(parent_keys, pa.binary()),
                ],
                schema=_SHARD_NODES,
            )
        )
        row_node = np.zeros(len(member), np.int64)
        row_node[active] = np.cumsum(starts) - 1
        above = (row_node, smallest.tolist(), keys)
        depth += 1
    return pa.Table.from_batches(parts, _SHARD_NODES)


def _in_common(one: str, two: str) -> Column:
    """How many first elements two arrays have in common."""
    differs = F.array_position(F.zip_with(one, two, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.size(one)).cast("int")


def _sharded(sequences: DataFrame, shard_turns: int) -> DataFrame:
    """``conv_id, ids, chars, shard, before, after``: shards in order, and what their edge rows share with the next."""
    spark = sequences.sparkSession
    rows = sequences.select(
        "conv_id",
        F.transform("turns", lambda t: t["id"]).alias("ids"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )
    rows = written(rows, "sequences")
    weight = rows.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    ranged = rows.repartitionByRange(max(1, -(-weight // shard_turns)), "ids", "conv_id")
    rows = written(ranged.withColumn("shard", F.spark_partition_id()), "shards")
    edges = rows.groupBy("shard").agg(
        F.min(F.struct("ids", "conv_id")).alias("first"), F.max(F.struct("ids", "conv_id")).alias("last")
    )
    edges = written(edges.select("shard", F.col("first.ids").alias("first"), F.col("last.ids").alias("last")), "edges")
    # One small number per shard; empty ones are skipped.
    numbers = sorted(r.shard for r in edges.select("shard").collect())
    pairs = spark.createDataFrame(list(zip(numbers, numbers[1:], strict=False)), "shard int, next int")
    following = edges.select(F.col("shard").alias("next"), F.col("first").alias("next_first"))
    meeting = F.broadcast(pairs).join(edges.select("shard", "last"), "shard").join(following, "next")
    meeting = meeting.select("shard", "next", _in_common("last", "next_first").alias("common"))
    after = meeting.select("shard", F.col("common").alias("after"))
    before = meeting.select(F.col("next").alias("shard"), F.col("common").alias("before"))
    neighbours = edges.select("shard").join(before, "shard", "left").join(after, "shard", "left")
    return rows.join(F.broadcast(neighbours.na.fill(-1)), "shard")


def prefix_trie(sequences: DataFrame, *, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of ``sequences``, ``(conv_id, turns)`` with one row per conversation.

    ``conv_id`` names a node by its smallest member; ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256`` as in the module's description.
    """
    schema = ", ".join(f"{f.name} {_SQL_TYPES[str(f.type)]}" for f in _SHARD_NODES)
    nodes = _sharded(sequences, shard_turns).groupBy("shard").applyInArrow(_shard_nodes, schema)
    nodes = written(nodes, "trie")
    result = ["conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256"]

    ends = F.array_sort(F.collect_list(F.when(F.col("ends") != "", F.struct("shard", "ends"))))
    joined = nodes.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in _SUMS],
        F.sha2(F.array_join(F.transform(ends, lambda e: e["ends"]), ","), 256).alias("ends_sha256"),
    )
    joined = written(joined, "joined")
    inside = nodes.where(F.col("key").isNull())
    done = inside.where(F.col("parent_key").isNull()).select(result)
    named = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"), F.col("n_children").alias("_size"))
    open_nodes = inside.where(F.col("parent_key").isNotNull()).drop("key", "parent_conv_id")
    open_nodes = open_nodes.unionByName(joined.where(F.col("parent_key").isNotNull()), allowMissingColumns=True)
    found = join_groups(open_nodes.drop("key"), named, ["parent_key"], "_size", open_nodes.count())
    found = found.withColumn("parent_conv_id", F.col("_parent")).select(result)
    root = joined.where(F.col("parent_key").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    return done.unionByName(found).unionByName(root.select(result))
