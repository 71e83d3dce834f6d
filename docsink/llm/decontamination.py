"""Benchmark decontamination with CGK embeddings (operator 8).

A document is contaminated by an item of ``n`` words if some run of its words
is within word edit distance ``n // 10`` of the item. Words are compared in
lower case without punctuation at their ends.

The CGK random walk turns edit distance into Hamming distance: one pointer runs
over a string, at every step the current word is written down, and a random bit
of (word, step) says whether the pointer moves on. Two strings a few edits
apart soon walk in step again. Windows as long as the items start at every word
of a document; sampled positions of their embedding are hashed and looked up
among the items. Each repetition has its own walk and its own sample. How many
are needed is measured on the items themselves, edited at random up to the
bound, so that ``recall`` of such windows are found. Every candidate is verified
by exact edit distance.

Before embedding, windows that cannot match are left out without loss: a match
starts with a word of an item and holds at most ``n // 10`` words no item has.

The items are the stated query set. They are prepared in blocks of at most
``BLOCK_ITEMS``, but all blocks are held at once, on the driver and by every
Python worker: a benchmark has to fit in a worker's memory.

Words are what stands between white space, and single characters of scripts
that are written without. Items of fewer than ten words allow no edit, so they
are found by their exact words, however short they are.

Defined results: null and empty texts match nothing, and items without words are
found nowhere. Equal items are all reported. Rows are judged one by one, so repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import mix64, text_of

SAMPLED = 3
RECALL = 0.99
MOST_REPEATS = 400
BLOCK_ITEMS = 20_000
CHUNK_CHARS = 1_500_000
MAX_REMEMBERED = 150_000  # words, in each of two generations

# Thai, Lao, Burmese, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

PAD, OTHER = 0, 1  # no word of an item


def edits_allowed(words: int) -> int:
    return words // 10


def raw_words(text: str) -> list[str]:
    """What stands between white space; each character of scripts that are written without."""
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    return text.split()


def normal(word: str) -> str:
    """Lower case, without signs at the ends."""
    word = word.lower()
    if word[:1].isalnum() and word[-1:].isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def places_of(item: list[int]) -> dict[int, int]:
    """Of each word the places where the item has it, as bits."""
    places: dict[int, int] = {}
    for i, symbol in enumerate(item):
        places[symbol] = places.get(symbol, 0) | 1 << i
    return places


def prefix_distance(item: list[int], words: list[int], most: int, places: dict[int, int] | None = None) -> int:
    """Least edit distance between ``item`` and a prefix of ``words``; ``most + 1`` if above ``most``.

    A column of the table of distances at a time, as bits of where it rises and
    falls (Myers); the first row counts the words passed.
    """
    if not item:
        return 0
    places = places_of(item) if places is None else places
    every, last = (1 << len(item)) - 1, 1 << len(item) - 1
    rises, falls = every, 0
    distance = best = len(item)
    for word in words[: len(item) + most]:
        equal = places.get(word, 0)
        along = equal | falls
        down = (((equal & rises) + rises) ^ rises) | equal
        up = falls | ~(down | rises) & every
        low = rises & down
        if up & last:
            distance += 1
        elif low & last:
            distance -= 1
            best = min(best, distance)
        up = (up << 1 | 1) & every
        rises = (low << 1 & every) | ~(along | up) & every
        falls = up & along
    return min(best, most + 1)


def _walk(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, seed: int, steps: np.ndarray) -> np.ndarray:
    """Hash of the embedding at the sampled ``steps``, for each window; ``symbols`` at ``ends`` is PAD."""
    keys = np.full(len(starts), np.uint64(seed), np.uint64)
    at = starts.astype(np.int64).copy()
    sampled = set(steps.tolist())
    with np.errstate(over="ignore"):
        for j in range(int(steps[-1]) + 1):
            if j % 64 == 0:
                bits = mix64(np.arange(width, dtype=np.uint64) + np.uint64((seed * 1_000_003 + j) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            current = symbols[at]
            if j in sampled:
                keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + current.astype(np.uint64))
            at += ((bits[current] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
            np.minimum(at, ends, out=at)
    return keys


class _Class:
    """Items of similar length: their walks are as long, so one set of windows serves all."""

    def __init__(self, items: list[tuple[int, np.ndarray]], width: int, recall: float) -> None:
        self.items = items
        sizes = [len(words) for _, words in items]
        self.shortest, self.most = min(sizes), edits_allowed(max(sizes))
        self.width = width
        self.places = [places_of(words.tolist()) for _, words in items]
        self.symbols, self.starts, self.ends = _joined([words for _, words in items])
        self.words = np.zeros(width, bool)
        self.words[np.unique(self.symbols)] = True
        self.words[[PAD, OTHER]] = False
        self.tables = []
        for repeat in range(self._repeats(recall)):
            steps = self._steps(repeat)
            keys = _walk(self.symbols, self.starts, self.ends, width, repeat + 1, steps)
            order = np.argsort(keys, kind="stable")
            self.tables.append((repeat + 1, steps, keys[order], order))

    def _steps(self, repeat: int) -> np.ndarray:
        # A pointer moves at every other step.
        rng = np.random.default_rng(repeat)
        return np.sort(rng.choice(2 * self.shortest, min(SAMPLED, 2 * self.shortest), replace=False))

    def _repeats(self, recall: float) -> int:
        """Repetitions that find ``recall`` of windows edited up to the bound, and half as many again."""
        if self.most == 0:
            return 1
        rng = np.random.default_rng(0)
        true, edited = [], []
        for i in rng.integers(0, len(self.items), 200):
            words = self.items[i][1]
            changed = list(words)
            for _ in range(edits_allowed(len(words))):
                kind, place = rng.integers(3), int(rng.integers(len(changed)))
                if kind == 0:
                    changed[place] = OTHER
                elif kind == 1:
                    changed.insert(place, OTHER)
                else:
                    del changed[place]
            while changed[0] == OTHER:
                del changed[0]
            true.append(words)
            edited.append(np.array(changed, np.int32))
        one, other = _joined(true), _joined(edited)
        missed = np.ones(len(true))
        for repeat in range(MOST_REPEATS):
            steps = self._steps(repeat)
            same = _walk(*one, self.width, repeat + 1, steps) == _walk(*other, self.width, repeat + 1, steps)
            missed[same] = 0
            if repeat >= 7 and missed.mean() <= 1 - recall:
                return (repeat + 1) * 3 // 2
        return MOST_REPEATS


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All parts in one array, each followed by PAD; where each starts and ends."""
    sizes = np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    symbols = np.zeros(int((sizes + 1).sum()), np.int32)
    for start, part in zip(starts, parts, strict=True):
        symbols[start : start + len(part)] = part
    return symbols, starts, starts + sizes


class ItemIndex:
    """Items prepared for searching; small enough to go along with every task."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL) -> None:
        split = [(i, [w for w in map(normal, raw_words(text or "")) if w]) for i, text in items]
        split = [(i, words) for i, words in split if words]
        names = sorted({w for _, words in split for w in words})
        self.number = {w: k + 2 for k, w in enumerate(names)}
        numbered = sorted(((i, np.array([self.number[w] for w in words], np.int32)) for i, words in split), key=lambda x: len(x[1]))
        self.classes, begin = [], 0
        while begin < len(numbered):
            shortest = len(numbered[begin][1])
            end = begin
            while end < len(numbered) and len(numbered[end][1]) <= max(shortest * 1.25, (shortest // 10 + 1) * 10 - 1):
                end += 1
            self.classes.append(_Class(numbered[begin:end], len(names) + 2, recall))
            begin = end

    def search(self, texts: list[str], remembered: dict[str, int]) -> list[dict[int, int]]:
        """For each text the items found in it, with the least distance found."""
        found: list[dict[int, int]] = [{} for _ in texts]
        if not self.classes:
            return found
        parts = []
        for text in texts:
            parts.append(np.fromiter(map(remembered.__getitem__, raw_words(text)), np.int32))
        parts = [p[p > 0] for p in parts]
        symbols, starts, ends = _joined(parts)
        of = np.repeat(np.arange(len(texts)), ends - starts + 1)
        for group in self.classes:
            marked = group.words[symbols]
            # The first words of a window: no more unknown ones than edits are allowed. Past the end counts as known.
            unknown = np.concatenate([[0], np.cumsum(~marked & (symbols != PAD))])
            at = np.flatnonzero(marked)
            stop = np.minimum(at + group.shortest, ends[of[at]])
            at = at[(unknown[stop] - unknown[at] <= group.most) & (ends[of[at]] - at >= group.shortest - group.most)]
            if not len(at):
                continue
            pairs = []
            for seed, steps, keys, order in group.tables:
                wanted = _walk(symbols, at, ends[of[at]], group.width, seed, steps)
                low, high = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
                hit = np.flatnonzero(high > low)
                times = (high - low)[hit]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                pairs.append(np.stack([np.repeat(at[hit], times), order[np.repeat(low[hit], times) + within]]))
            for place, item in np.unique(np.concatenate(pairs, axis=1), axis=1).T.tolist():
                doc = of[place]
                name, words = group.items[item]
                most = edits_allowed(len(words))
                best = found[doc].get(name, most + 1)
                if best == 0:
                    continue
                there = symbols[place : min(place + len(words) + most, ends[doc])]
                if np.array_equal(there[: len(words)], words):
                    found[doc][name] = 0
                    continue
                distance = prefix_distance(words.tolist(), there.tolist(), most, group.places[item])
                if distance < best:
                    found[doc][name] = distance
        return found


class _Numbers(dict):
    """Number of a raw word; 0 for what is no word at all."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__()
        self.known = known
        self.older: dict[str, int] = {}

    def __missing__(self, raw: str) -> int:
        number = self.older.get(raw)
        if number is None:
            word = normal(raw)
            number = self.known.get(word, OTHER) if word else PAD
        if len(self) >= MAX_REMEMBERED:
            # Words that come again are taken over from the generation before.
            self.older = dict(self)
            self.clear()
        self[raw] = number
        return number


def _matches(index: ItemIndex, text: str) -> Column:
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        remembered = _Numbers(index.number)
        for batch in batches:
            texts, found, begin = batch.tolist(), [], 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= CHUNK_CHARS):
                    size += len(texts[end])
                    end += 1
                found += index.search(texts[begin:end], remembered)
                begin = end
            yield pd.DataFrame(
                {"items": [sorted(f) for f in found], "distances": [[f[i] for i in sorted(f)] for f in found]}
            )

    search.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(search, "items array<long>, distances array<int>")(text_of(text))


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    blocks = max(1, -(-benchmark.count() // BLOCK_ITEMS))
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [(row.item_id, row.text) for row in part.select("item_id", "text").collect()]


def _all_matches(docs: DataFrame, benchmark: DataFrame, text: str) -> Column:
    found = [_matches(ItemIndex(items), text) for items in _blocks(benchmark.where("item_id is not null"))]
    return F.struct(
        F.concat(*[f["items"] for f in found]).alias("items"), F.concat(*[f["distances"] for f in found]).alias("distances")
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, contaminated, item_ids, distances``."""
    found = docs.select("doc_id", _all_matches(docs, benchmark, text).alias("m"))
    return found.select(
        "doc_id",
        (F.size("m.items") > 0).alias("contaminated"),
        F.col("m.items").alias("item_ids"),
        F.col("m.distances").alias("distances"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows that hold no item, with the columns of ``docs``."""
    rows = docs.select(F.struct("*").alias("_row"), _all_matches(docs, benchmark, text).alias("_m"))
    return rows.where(F.size("_m.items") == 0).select("_row.*")
