import random

import pytest

from docsink.llm.decontamination import (
    contamination_report,
    drop_contaminated,
    edits_allowed,
    normal,
    prefix_distance,
)
from tests.llm.conftest import prose


def words_of(text):
    return [w for w in map(normal, (text or "").split()) if w]


def best_distance(item, words):
    """Edit distance to the most similar run of words, by plain dynamic programming."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text, seed, times):
    rng, words = random.Random(seed), text.split()
    for _ in range(times):
        kind, place = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[place] = f"other{rng.randrange(99)}"
        elif kind == 1:
            words.insert(place, f"other{rng.randrange(99)}")
        else:
            del words[place]
    return " ".join(words)


@pytest.fixture
def items(spark):
    rows = [(i, prose(1000 + i, 12 + 3 * i)) for i in range(16)]
    rows += [(50, "only four words here"), (51, ""), (52, None), (53, rows[0][1]), (None, prose(5, 20)), (54, "five words and no more")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_equals_brute_force(documents, items):
    rows, benchmark = items
    docs = [(i, prose(i, 60)) for i in range(40)]
    for k in range(160):
        text = edited(rows[k % 16][1], k, k // 16 % 8)
        docs.append((100 + k, f"{prose(k, 25)}. {text}, {prose(k + 7, 25)}"))
    docs += [(400, None), (401, ""), (402, rows[3][1].upper()), (402, rows[3][1]), (403, "FIVE words, and: no more!")]
    docs += [(404, prose(9, 40_000) + " " + rows[7][1] + " tail"), (405, rows[5][1] + " " + rows[6][1])]
    got = contamination_report(documents(docs, item_ids="x", items="y"), benchmark).collect()
    assert len(got) == len(docs)
    by_id = {(r.doc_id, tuple(r.item_ids)) for r in got}
    missed = 0
    for i, text in docs:
        words, want = words_of(text), []
        for item, said in rows:
            target = words_of(said)
            if item is not None and len(target) >= 5 and best_distance(target, words) <= edits_allowed(len(target)):
                want.append(item)
        found = [set(ids) for d, ids in by_id if d == i]
        assert all(f <= set(want) for f in found)
        missed += not any(f == set(want) for f in found)
    assert missed <= 2  # of about 90 edited passages, at a target recall of 0.99
    assert all(r.contaminated == bool(r.item_ids) and len(r.distances) == len(r.item_ids) for r in got)


def test_blocks_of_items(documents, items, monkeypatch):
    rows, benchmark = items
    monkeypatch.setattr("docsink.llm.decontamination.BLOCK_ITEMS", 5)
    docs = documents([(i, f"before {rows[i][1]} after") for i in range(16)])
    got = contamination_report(docs, benchmark).collect()
    assert all(r.doc_id in r.item_ids for r in got)


def test_drops_whole_rows(documents, items):
    rows, benchmark = items
    docs = documents([(1, rows[4][1]), (2, "clean " * 30), (3, None)], _row="x", _m="y")
    got = drop_contaminated(docs, benchmark)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [2, 3]
    nothing = benchmark.where("false")
    assert drop_contaminated(docs, nothing).count() == 3
    assert contamination_report(documents([]), benchmark).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_prefix_distance(seed):
    rng = random.Random(seed)
    item = [rng.randrange(6) for _ in range(rng.randrange(1, 15))]
    words = [rng.randrange(6) for _ in range(rng.randrange(0, 25))]
    most = rng.randrange(0, 4)

    def distance(prefix):
        row = list(range(len(prefix) + 1))
        for i, a in enumerate(item, 1):
            new = [i]
            for j, b in enumerate(prefix, 1):
                new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
            row = new
        return row[-1]

    want = min(distance(words[:n]) for n in range(len(words) + 1))
    assert prefix_distance(item, words, most) == min(want, most + 1)


def plain_distance(item, words, most):
    row = list(range(len(words) + 1))
    for i, symbol in enumerate(item, 1):
        new = [i]
        for j, word in enumerate(words, 1):
            new.append(min(row[j - 1] + (word != symbol), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(min(row), most + 1)


def test_distance_by_bits_equals_the_table():
    rng = random.Random(11)
    for _ in range(2000):
        n = rng.choice([0, 1, 3, 10, 40, 90])
        item = [rng.randrange(2, 2 + rng.choice([2, 5, 50])) for _ in range(n)]
        words = list(item)
        for _ in range(rng.randint(0, 8)):
            place = rng.randint(0, len(words))
            rng.choice([lambda: words.insert(place, rng.randrange(60)), lambda: words.pop(place - 1) if words else None])()
        words += [rng.randrange(60) for _ in range(rng.randint(0, 10))]
        most = rng.choice([0, 1, n // 10, n])
        got = prefix_distance(item, words[: n + most], most)
        assert got == plain_distance(item, words[: n + most], most)


def test_short_and_unspaced_items(spark):
    items = [(1, "what is blood"), (2, "\u65e5\u672c\u8a9e\u306e\u554f\u984c"), (3, "Photosynthesis"), (4, "..."), (5, None), (6, "four words only here")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = {
        1: "so: What, is blood? asked",
        2: "\u3053\u308c\u306f\u65e5\u672c\u8a9e\u306e\u554f\u984c\u3067\u3059",
        3: "photosynthesis!",
        6: "a b FOUR words (only) here c",
        7: "what was blood, four words only there, \u65e5\u672c\u8a9e",
        8: "... nothing ...",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in contamination_report(docs, benchmark).collect()}
    assert got == {i: [i] if i in (1, 2, 3, 6) else [] for i in texts}
