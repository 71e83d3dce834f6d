"""Prefix tries against a plain one, with shards of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from docsink.llm.prefix_trie import COLUMNS, _sorted_rows, prefix_trie, turn_sequences, with_shared_heads

SCHEMA = "conv_id long, turn int, role string, text string, shard int, turns string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def ordered(rows):
    """The turns ``(role, text)`` of each conversation."""
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held[c].append((turn is not None, turn or 0, digest, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in held.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        own = (len(of) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += own
            leaves[node[:d]] += children[node] == 0
    return sorted(
        (
            min(of), len(node), min(members[node[:-1]]) if node else -1, len(of), children[node], leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(c for c in of if len(convs[c]) == len(node)))).encode()).hexdigest(),
        )
        for node, of in members.items()
    )


def found(trie):
    return sorted(tuple(-1 if v is None else v for v in row) for row in trie.collect())


def test_rows_are_ordered_like_lists():
    rng = random.Random(2)
    for _ in range(60):
        rows = [[rng.randrange(2) for _ in range(rng.choice([0, 1, 3, COLUMNS, COLUMNS + 1, 2 * COLUMNS, 80]))] for _ in range(20)]
        rows += [r[: rng.randint(0, len(r))] + [rng.randrange(2)] * rng.randint(0, 3) for r in rows]
        rows += [[0] * rng.randrange(100) for _ in range(10)]
        offset = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        ids = np.array([x for r in rows for x in r] + [9] * COLUMNS, np.int32)
        order, common = _sorted_rows(ids, offset)
        got = [rows[i] for i in order]
        assert got == sorted(rows)
        for one, two, n in zip(got, got[1:], common[1:].tolist(), strict=False):
            assert one[:n] == two[:n] and (min(len(one), len(two)) == n or one[n] != two[n])


def random_conversations(rng, n):
    rows = []
    for c in rng.sample(range(-150, 400), n):
        m = rng.choice([0, 1, 2, 3, 5, 8, 40])
        for turn in range(m):
            rows.append((c, rng.choice([turn, turn, None, 3]), rng.choice(["user", "bot", None]), rng.choice(["a", "éé", "", None])))
    return rows


@pytest.mark.parametrize(("seed", "shard_turns"), [(1, 200_000), (2, 40), (3, 7), (4, 1)])
def test_trie_equals_a_plain_one(spark, seed, shard_turns):
    rows = random_conversations(random.Random(seed), 120)
    convs = ordered(rows)
    sequences = turn_sequences(frame(spark, rows))
    assert found(prefix_trie(sequences, shard_turns=shard_turns)) == plain_trie(convs)
    assert found(prefix_trie(with_shared_heads(sequences), shard_turns=shard_turns)) == plain_trie(rebuilt(convs))


def test_equal_conversations_over_several_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3 + (c % 50 == 0))]
    trie = prefix_trie(turn_sequences(frame(spark, rows)), shard_turns=50)
    assert found(trie) == plain_trie(ordered(rows))


def test_long_conversations(spark):
    rows = [(1, t, "user", "yes") for t in range(3000)] + [(2, t, "user", "yes") for t in range(2500)] + [(3, 0, "user", "no")]
    trie = found(prefix_trie(turn_sequences(frame(spark, rows)), shard_turns=100))
    # The plain trie is quadratic in memory; count instead.
    assert len(trie) == 3002
    assert trie.count((1, 3000, 1, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())) == 1
    root = next(r for r in trie if r[1] == 0)
    assert root[:-1] == (1, 0, -1, 3, 2, 2, 2500 * 3)


def test_defined_results(spark):
    assert found(prefix_trie(turn_sequences(frame(spark, [])))) == []
    rows = [(None, 0, "user", "nobody"), (8, None, None, None), (8, None, None, None), (8, 0, "user", "x"), (308, 0, "a", "bc")]
    rows += [(309, 0, "ab", "c")]
    trie = found(prefix_trie(turn_sequences(frame(spark, rows))))
    assert trie == plain_trie(ordered(rows)) and len(trie) == 6


def test_conversations_without_turns(spark):
    """A conversation whose few turns all give way to a missing one keeps only the root."""
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(short, 0, "user", "gone")]
    trie = found(prefix_trie(with_shared_heads(turn_sequences(frame(spark, rows)))))
    assert trie == [(short, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]
