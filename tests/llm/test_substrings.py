"""Removal of repeated passages against a plain search."""

import random
import re

import numpy as np
import pytest

from docsink.llm.substrings import _Chunk, repeat_report, without_repeats
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, part string"


def frame(spark, rows, partitions=1):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(partitions)


def plain(rows, window):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone = set()
        for start in range(len(words) - window + 1):
            found = tuple(words[start : start + window])
            if found in seen:
                gone.update(range(start, start + window))
            seen.add(found)
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def found(docs, window=20):
    return sorted(map(tuple, without_repeats(docs, window=window).collect()), key=str)


def patchwork(rng, n):
    """Texts of own words, of passages that others have too, and of few words over and over."""
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randint(3, 60))] for _ in range(8)]
    rows = []
    for i in rng.sample(range(1000), n):
        words = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.4:
                passage = rng.choice(passages)
                a = rng.randrange(len(passage))
                words += passage[a : a + rng.randint(1, 60)]
            elif kind < 0.7:
                words += [f"w{rng.randrange(1000)}" for _ in range(rng.randint(1, 25))]
            elif kind < 0.85:
                words += ["x"] * rng.randint(1, 50)
            else:
                words += (["a", "b", "c"][: rng.randint(1, 3)] * 30)[: rng.randint(1, 50)]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


@pytest.mark.parametrize(("seed", "window", "partitions"), [(1, 20, 1), (2, 20, 7), (3, 6, 5), (4, 33, 3), (5, 3, 4)])
def test_equals_a_plain_search(spark, seed, window, partitions):
    rows = patchwork(random.Random(seed), 80)
    wanted = plain(rows, window)
    assert found(frame(spark, rows, partitions), window) == wanted
    assert sum(r[2] for r in wanted) > 200


def test_a_repeated_window_holds_the_same_anchors():
    """Whatever lies around it."""
    rng = random.Random(9)
    for _ in range(40):
        passage = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(60)]
        texts = [
            " ".join([*rng.choices("abcdxyz", k=rng.randint(0, 30)), *passage, *rng.choices("abcdxyz", k=rng.randint(0, 30))])
            for _ in range(3)
        ]
        sets = []
        for text in texts:
            chunk = _Chunk([text.encode()], 20)
            joined = text.split()
            start = next(i for i in range(len(joined)) if joined[i : i + 60] == passage)
            held = set()
            for s in range(start, start + 41):
                inside = (chunk.low >= s) & (chunk.high <= s + 20)
                held.update((s - start, int(a)) for a in chunk.anchors[inside])
            sets.append(held)
        assert sets[0] == sets[1] == sets[2] != set()


def test_hashes_of_windows():
    words = [str(i % 37) for i in range(400)]
    for window in (1, 2, 3, 20, 31, 32):
        chunk = _Chunk([" ".join(words).encode()], window)
        keys = chunk.window_hashes(0xD6E8FEB86659FD93)[: 400 - window + 1]
        assert (keys[:-37] == keys[37:]).all() and len(np.unique(keys)) == 37


def test_defined_results(spark):
    text = prose(1, 50)
    rows = [(5, text), (5, text), (None, text), (None, None), (7, ""), (8, " \n"), (9, prose(1, 19)), (10, None)]
    wanted = plain(rows, 20)
    assert found(frame(spark, rows)) == wanted
    assert sum(r[2] for r in wanted) == 100
    assert found(frame(spark, rows).limit(0)) == []
    assert repeat_report(frame(spark, rows)).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_a_passage_in_all_documents_and_a_long_text(spark):
    shared = prose(3, 45)
    rows = [(i, f"{prose(i + 10, 30)} {shared} {prose(i + 5000, 12)}") for i in range(400)]
    rows += [(9000 + i, shared) for i in range(100)] + [(9999, " ".join([prose(77, 3000)] * 4) + " " + "x " * 60_000)]
    assert found(frame(spark, rows, 6)) == plain(rows, 20)
