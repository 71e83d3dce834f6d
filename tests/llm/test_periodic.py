"""Periodic runs against a plain search, on words, on texts and on a given table."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from docsink.llm.periodic import find_runs, periodic_runs, planted, run_report
from docsink.llm.words import split_words
from tests.test_oracle import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    """``start, end, period`` of all runs, by trying every period."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.array([numbers[w] for w in words])
    found = {}
    for period in range(1, len(words) // 3 + 1):
        equal = np.concatenate([[False], codes[:-period] == codes[period:], [False]])
        turn = np.flatnonzero(equal[1:] != equal[:-1])
        for i, j in zip(turn[0::2].tolist(), turn[1::2].tolist(), strict=True):
            if j + period - i >= max(24, 3 * period):
                found.setdefault((i, j + period), period)
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_report(words):
    runs = plain_runs(words)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    first = (None,) * 4
    if best:
        s, e, q = best
        first = (s, e - s, q, 1000 * (e - s) // q)
    return (len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def repetitive(rng):
    alphabet = rng.choice([1, 2, 2, 3, 4, 8])
    words = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.4:
            words += [rng.randrange(alphabet) for _ in range(rng.randint(0, 30))]
            continue
        unit = [rng.randrange(alphabet) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.5:
            inner = [rng.randrange(alphabet) for _ in range(rng.randint(1, 5))]
            unit = inner * rng.randint(1, 12) + unit[: rng.randint(0, 5)]
        words += (unit * 7)[: rng.randint(1, 6 * len(unit))]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_a_plain_search(seed):
    rng = random.Random(seed)
    found = 0
    for _ in range(150):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 4))]
        symbols, wanted = [], []
        for number, text in enumerate(texts):
            wanted += [(s + len(symbols), e + len(symbols), q) for s, e, q in plain_runs(text)]
            symbols += [1000 * number + w for w in text]
        got = find_runs(np.array(symbols, np.uint64))
        assert list(zip(*[x.tolist() for x in got], strict=True)) == wanted
        found += len(wanted)
    assert found > 200


def test_one_word_over_and_over():
    start, end, period = find_runs(np.zeros(100_000, np.uint64))
    assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [100_000], [1])


def test_words_and_their_numbers():
    rng = random.Random(5)
    for _ in range(200):
        texts = ["".join(rng.choice("ab \t\n\x0bcdé—") for _ in range(rng.randint(0, 60))) for _ in range(4)]
        words = split_words([t.encode() for t in texts])
        plain = [w for t in texts for w in WORD.findall(t)]
        assert [bytes(words.data[a:b]).decode() for a, b in zip(words.start, words.end, strict=True)] == plain
        numbers = words.numbers().tolist()
        assert len(set(zip(plain, numbers, strict=True))) == len(set(plain)) == len(set(numbers))
        kept = np.array([rng.random() < 0.5 for _ in plain], bool)
        flags = iter(kept)
        assert words.joined(kept) == [" ".join(w for w in WORD.findall(t) if next(flags)).encode() for t in texts]


def test_defined_results(spark):
    line = " ".join(["we all agree"] * 10)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, line), (4, line), (None, f"well\x0b{line}  so"), (5, "word " * 23), (6, "word " * 24)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, runs string, n_words int")
    rows = sorted(map(tuple, run_report(docs).collect()), key=str)
    wanted = [(i, *plain_report(WORD.findall(t or ""))) for i, t in texts]
    assert rows == sorted(wanted, key=str)
    assert run_report(docs.limit(0)).collect() == []
    out = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert out[4].collapsed == "we all agree" and out[None].n_words == 32
    assert out[None].collapsed == "well we all agree agree  so"


def test_long_text(spark):
    rng = random.Random(3)
    words = [str(rng.randrange(50)) for _ in range(30_000)]
    words[10_000:25_000] = (words[:4_000] * 4)[:15_000]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = periodic_runs(docs).first()
    assert [r.period for r in row.runs] == [4_000]
    assert row.n_words == 30_000


def test_given_table(spark):
    """Every row, with the planted ends."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in run_report(docs.withColumn("text", planted(docs))).collect()}
    found = 0
    for row in docs.collect():
        words = WORD.findall(row.text or "")
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        wanted = plain_report(words)
        found += wanted[0]
        assert got[row.doc_id] == wanted
    assert found
