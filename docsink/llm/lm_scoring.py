"""Hierarchical Pitman-Yor language model (operator 2).

Restaurants: one per word (as the word before), one per class of words (by
their last letters) and one for the start of a text. A word's restaurant has
its class as parent, so classes are shared by many words. Classes and the start
have the root as parent. The root's base is continuous: a table of the root is
a word, and what the root leaves over is the probability of a word not seen in
training, the one further outcome.

Seating is sampled by Gibbs. A sweep draws for every word of a restaurant the
number of its tables, given the tables of the others, from its exact conditional
(generalised Stirling numbers) up to ``EXACT`` customers; further customers are
seated in order, in growing blocks. Tables are customers of the parent.

No word is left without a restaurant; ``HOT_WORDS`` only says where one is
kept. Words are dealt out into parts, and all contexts of a word lie in its
part. Restaurants of the ``HOT_WORDS`` most frequent words, of the classes and of
the start spread over all parts: a sweep is local but for their totals, a
few thousand numbers that are summed up between passes (they are then sampled
side by side given the last totals). A rarer word's restaurant meets whole in
the part of that word: the other parts send it the customers they hold with
their probability in the class, its tables are drawn there, and every part gets
back its tables and the restaurant's totals. Its strength is the best one for
the restaurants of a part, by the leave-one-out likelihood.

Predictive probabilities are averaged over the last sweeps of the classes and
frequent words; discounts follow from the counts of counts, strengths from the
leave-one-out likelihood of all training tokens.

Tokens are kept packed: a task sorts the tokens of a stretch of documents by
word and writes them per part; only parts move. A frequent word after a rarer
one lies in the rarer one's part. Frequent words after frequent words hold most
tokens and could not be dealt out: their probabilities are a table bounded by
``HOT_WORDS`` times the number of restaurants that spread, which goes to the
documents instead. A part has about ``PART_TOKENS`` tokens up to ``MOST_PARTS``
parts.

Defined results: a null or empty text is its end alone. Rows are scored one by
one, also with equal or null ``doc_id`` (null is a training row). Without any
training token every word is unknown with probability 1, score 0.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import text_of, written
from docsink.llm.words import Words, split_words
from docsink.plans.tables import work_dir

HOT_WORDS = 1024
CLASSES = 64
START = CLASSES  # context of a text's first token
PART_TOKENS = 2_500_000
LEAST_PARTS = 24
MOST_PARTS = 50_000
HOT_PARTS = 16
STRETCH_TOKENS = 1_500_000
SLICE_BYTES = 2_000_000  # of texts cut into words together
BLOCK_WORDS = 500_000  # numbered together
LONG = 128  # bytes of a word, beyond which it is hashed by itself
EXACT = 40
SWEEPS = 2  # between exchanges of totals
EXCHANGES = 2
SAMPLES = 3
STRENGTHS = (2.0, 50.0, 1000.0, 20_000.0, 400_000.0)
TOP_STRENGTH = 1.0
RARE_STRENGTHS = (0.25, 1.0, 4.0, 16.0, 64.0)
TURNS = 32  # of the words of a rarer word's restaurant, in a sweep

_LOW = (1 << 58) - 1
_KINDS = {"rare": 0, "hot": 1, "docs": 2, "counts": 3, "after": 4, "rare tokens": 5, "after tokens": 6}
_SEATS, _AFTER_SEATS, _GROWN = 0, 1, 2
_PIECES = "kind int, part long, stretch long, a binary, b binary, c binary, d binary, e binary"
# Cells in the first columns, their tokens in the next, what goes with the documents in the last, so that each is read alone.
_PACKED = "kind int, part long, stretch long, " + ", ".join(f"{name} binary" for name in "abcdefghi")
_PLACES = {"cells": 0, "tokens": 3, "documents": 6}



def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 1, F.lit(False))


# Class of a word by its last two bytes, and of a word of one byte.
_CLASS_OF_TWO = np.array([zlib.crc32(bytes([a, b])) % CLASSES for a in range(256) for b in range(256)], np.uint64)
_CLASS_OF_ONE = np.array([zlib.crc32(bytes([b])) % CLASSES for b in range(256)], np.uint64)
_END = _CLASS_OF_ONE[32] << np.uint64(58) | np.uint64(xxhash.xxh64_intdigest(b" ") & _LOW)  # no word holds a space


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens, an end after each text, and tokens per text."""
    numbers, sizes = [], []
    waiting, held = [], 0
    for text in texts:
        waiting.append(text.encode("utf-8", "surrogatepass").lower())
        held += len(waiting[-1])
        if held > SLICE_BYTES:  # places of words take more memory than numbers
            numbers, sizes = _numbered(waiting, numbers, sizes)
            waiting, held = [], 0
    numbers, sizes = _numbered(waiting, numbers, sizes)
    return np.concatenate(numbers), np.concatenate(sizes)


def _numbered(texts: list[bytes], numbers: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[list, list]:
    """With the tokens of some more texts. Number of a word: its class in the high bits, a hash below."""
    words = split_words(texts)
    length = words.end - words.start
    low = np.empty(len(length), np.uint64)
    for first in range(0, len(length), BLOCK_WORDS):
        at = first + np.flatnonzero(length[first : first + BLOCK_WORDS] <= LONG)
        low[at] = Words(words.n, words.data, words.start[at], words.end[at], words.doc[at]).numbers()
    for i in np.flatnonzero(length > LONG).tolist():
        low[i] = xxhash.xxh64_intdigest(words.data[words.start[i] : words.end[i]].tobytes())
    last = words.data[words.end - 1].astype(np.int64)
    of = np.where(length > 1, _CLASS_OF_TWO[256 * words.data[words.end - 2].astype(np.int64) + last], _CLASS_OF_ONE[last])
    found = np.full(len(length) + len(texts), _END)
    found[np.arange(len(length)) + words.doc] = of << np.uint64(58) | low & np.uint64(_LOW)
    return [*numbers, found], [*sizes, np.bincount(words.doc, minlength=len(texts)) + 1]


def _pack(array: np.ndarray) -> bytes:
    """Compressed, first bytes before second bytes and so on."""
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_all(*packed: bytes) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in packed)


def _unpack_all(data: bytes) -> list[bytes]:
    found, at = [], 0
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at : at + 8], "little")
        found.append(data[at + 8 : end])
        at = end
    return found


def _pack_contexts(codes: np.ndarray, words: np.ndarray) -> bytes:
    """Contexts of tokens: a frequent word, the start or a class by its place; the words of the classes apart, each once."""
    once, which = np.unique(words.astype("<u8"), return_inverse=True)
    return _pack_all(_pack(codes.astype("<u2")), _pack(once), _pack(which.astype("<u4")))


def _unpack_contexts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places, and one number for every context."""
    codes, once, which = _unpack_all(data)
    codes, once = _unpack(codes, "<u2"), _unpack(once, "<u8")
    contexts = codes.astype(np.uint64)
    if len(once):
        contexts[codes < CLASSES] = once[_unpack(which, "<u4")]
    return codes, contexts


def _part_of(words: np.ndarray, parts: int) -> np.ndarray:
    return ((words & np.uint64(_LOW)) % np.uint64(parts)).astype(np.int64)


def _class_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(58)).astype(np.int64)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Documents of bounded size together: ids, held out, tokens and tokens per text."""
    waiting, size = ([], [], []), 0
    for batch in (whole.slice(at, 500) for whole in batches for at in range(0, len(whole), 500)):
        for row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if waiting[0] and size + len(row[2]) > 6 * STRETCH_TOKENS:
                yield waiting[0], waiting[1], *_tokens(waiting[2])
                waiting, size = ([], [], []), 0
            for column, value in zip(waiting, row, strict=True):
                column.append(value)
            size += len(row[2])
    if waiting[0]:
        yield waiting[0], waiting[1], *_tokens(waiting[2])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new)


def _counted(parts: int):
    """Training tokens of a task, counted and packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, tokens, sizes in _stretches(batches):
            words, counts = np.unique(tokens[np.repeat(~np.array(held, bool), sizes)], return_counts=True)
            yield from _by_part(words, counts.astype(np.uint32), parts)

    return run


def _by_part(words: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    part = (words & np.uint64(_LOW)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    words, counts, part = words[order], counts[order], part[order]
    if len(part):
        starts = _runs(part)
        pieces = list(zip(starts, [*starts[1:], len(part)], strict=True))
        yield pa.record_batch(
            {
                "part": pa.array(part[starts].astype(np.int64)),
                "words": [_pack(words[a:b]) for a, b in pieces],
                "counts": [_pack(counts[a:b]) for a, b in pieces],
            }
        )


def _most_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent words of the parts a task owns, and the tokens in them."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["part"], []).append((_unpack(row["words"], "<u8"), _unpack(row["counts"], "<u4")))
    for rows in held.values():
        words, place = np.unique(np.concatenate([w for w, _ in rows]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in rows])).astype(np.int64)
        best = np.argsort(-counts, kind="stable")[:HOT_WORDS]
        yield pa.record_batch({"word": words[best].view(np.int64), "count": counts[best]})


def hot_words(rows: DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent training words, as sorted numbers, and how often they occur."""
    counts = rows.mapInArrow(_counted(parts), "part long, words binary, counts binary").repartition(parts, "part")
    found = counts.mapInArrow(_most_frequent, "word long, count long").orderBy(F.desc("count"), "word").limit(HOT_WORDS)
    found = found.collect()
    words = np.array([row.word for row in found], np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], np.array([row["count"] for row in found], np.int64)[order]


def _find(hot: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the frequent words, and whether it is one."""
    if not len(hot):
        return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), bool)
    place = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    return place, hot[place] == tokens


def _occurrences(hot: np.ndarray, parts: int):
    """Tokens of stretches of documents: by part, but frequent words in contexts that spread with their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for names, held, tokens, sizes in _stretches(batches):
            doc = np.repeat(np.arange(len(names), dtype=np.uint32), sizes)
            place, is_hot = _find(hot, tokens)
            place = place.astype(np.uint16)
            code, before = np.empty(len(tokens), np.uint16), np.empty_like(tokens)
            code[1:] = np.where(is_hot, CLASSES + 1 + place, _class_of(tokens))[:-1]
            before[1:] = tokens[:-1]
            code[np.cumsum(sizes) - sizes] = START
            after_rare = code < CLASSES
            before[~after_rare] = code[~after_rare]
            train = ~np.array(held, bool)[doc]
            rows = []
            ids = np.array([n or 0 for n in names], np.int64)
            known = np.array([n is not None for n in names])
            flags = known.astype(np.uint8) | (np.array(held, np.uint8) << 1)
            rows.append((_KINDS["docs"], number, _pack(ids), _pack(flags), _pack(sizes), b"", b""))
            at = np.flatnonzero(is_hot & ~after_rare)
            rows.append((_KINDS["hot"], number, _pack(doc[at]), _pack(place[at]), _pack(code[at]), b"", b""))
            at = at[train[at]]
            pairs = (place[at].astype(np.int64) << 16) | code[at]
            # Also frequent words that only rarer ones precede get a cell here, if an empty one.
            all_after = np.unique(place[is_hot & after_rare & train]).astype(np.int64) << 16 | START
            pairs, which = np.unique(np.append(pairs, all_after), return_inverse=True)
            counts = np.bincount(which[: len(at)], minlength=len(pairs))
            part = parts + (pairs >> 16) % HOT_PARTS
            for p in np.unique(part).tolist():
                mine = part == p
                rows.append(
                    (
                        _KINDS["counts"],
                        p,
                        _pack_words(hot[pairs[mine] >> 16]),
                        _pack_contexts(pairs[mine] & 0xFFFF, np.zeros(0)),
                        _pack(counts[mine].astype(np.uint32)),
                        b"",
                        b"",
                    )
                )
            for p, mine in _dealt(np.flatnonzero(~is_hot), tokens, before, parts):
                at = _runs_of_pairs(tokens[mine], before[mine])
                cells = mine[at]
                contexts = _pack_contexts(code[cells], before[cells[after_rare[cells]]])
                rows.append((_KINDS["rare"], p, _pack_words(tokens[cells]), contexts, *_pack_run(at, doc[mine], train[mine])))
            for p, mine in _dealt(np.flatnonzero(is_hot & after_rare), before, place, parts):
                at = _runs_of_pairs(before[mine], place[mine])
                cells = mine[at]
                contexts = _pack_contexts(place[cells], np.zeros(0))
                rows.append((_KINDS["after"], p, _pack_words(before[cells]), contexts, *_pack_run(at, doc[mine], train[mine])))
            yield pa.record_batch(
                {
                    "kind": pa.array([r[0] for r in rows], pa.int32()),
                    "part": pa.array([r[1] for r in rows], pa.int64()),
                    "stretch": pa.array([number] * len(rows), pa.int64()),
                    **{name: pa.array([r[i] for r in rows], pa.binary()) for i, name in enumerate("abcde", 2)},
                }
            )
            number += 1

    return run


def _pack_run(at: np.ndarray, doc: np.ndarray, train: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Documents of tokens, and of every cell the training tokens and all tokens."""
    times = np.diff(np.append(at, len(doc))).astype("<u4")
    return _pack(np.add.reduceat(train, at, dtype=np.uint32)), _pack(times), _pack(doc)


def _dealt(at: np.ndarray, owner: np.ndarray, other: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Tokens by the part of their owner, sorted by the owner and the other word."""
    part = _part_of(owner[at], parts)
    order = np.lexsort((other[at], owner[at], part))
    at, part = at[order], part[order]
    starts = _runs(part)
    for a, b in zip(starts, [*starts[1:], len(part)], strict=False):
        yield int(part[a]), at[a:b]


def _pack_words(words: np.ndarray) -> bytes:
    """Sorted words, each once, and how often."""
    runs = _runs(words)
    return _pack(np.concatenate([words[runs], np.diff(np.append(runs, len(words))).astype(np.uint64)]))


def _words_once(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = _unpack(data, "<u8")
    half = len(both) // 2
    return both[:half], both[half:].astype(np.int64)


def _words_of(data: bytes) -> np.ndarray:
    """Word of every token of a packed piece."""
    return np.repeat(*_words_once(data))


def _cells_of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counted pairs of word and context of a piece."""
    for batch in batches:
        yield batch.select(["part", "a", "b", "c"])


def _contexts_of(kind: int, codes: np.ndarray, contexts: np.ndarray) -> bytes:
    return _pack_contexts(codes, contexts[codes < CLASSES] if kind != _KINDS["after"] else np.zeros(0))


def _runs_of_pairs(words: np.ndarray, context: np.ndarray) -> np.ndarray:
    new = np.ones(len(words), bool)
    new[1:] = (words[1:] != words[:-1]) | (context[1:] != context[:-1])
    return np.flatnonzero(new)


def _merge(kind: int, pieces: list[tuple[bytes, bytes, bytes]]) -> tuple[tuple[bytes, bytes, bytes], list[np.ndarray]]:
    """All cells of pieces, sorted by word and context, and which of them the cells of every piece are."""
    words = [_words_of(a) for a, _, _ in pieces]
    ends = np.cumsum([len(w) for w in words])
    words = np.concatenate(words)
    both = [_unpack_contexts(b) for _, b, _ in pieces]
    codes, contexts = np.concatenate([b[0] for b in both]), np.concatenate([b[1] for b in both])
    del both
    order = np.lexsort((contexts, words))
    words = words[order]
    contexts = contexts[order]
    at = _runs_of_pairs(words, contexts)
    counts = np.add.reduceat(np.concatenate([_unpack(c, "<u4") for _, _, c in pieces])[order], at, dtype=np.uint32)
    packed = _pack_words(words[at]), _contexts_of(kind, codes[order[at]], contexts[at]), _pack(counts)
    cell = np.empty(len(order), np.int64)
    cell[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    return packed, np.split(cell, ends[:-1])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All cells of a part in one row."""
    held: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            held.setdefault(row["part"], []).append((row["a"], row["b"], row["c"]))
    for part, rows in held.items():
        (a, b, c), _ = _merge(_KINDS["counts"], rows)
        yield pa.record_batch({"part": pa.array([part], pa.int64()), "a": [a], "b": [b], "c": [c]})


def _stored(kind: int, part: int, stretch: int, place: str, packed: tuple[bytes, bytes, bytes]) -> pa.RecordBatch:
    columns = [None] * 9
    columns[_PLACES[place] : _PLACES[place] + 3] = packed
    return pa.record_batch(
        {
            "kind": pa.array([kind], pa.int32()),
            "part": pa.array([part], pa.int64()),
            "stretch": pa.array([stretch], pa.int64()),
            **{name: pa.array([value], pa.binary()) for name, value in zip("abcdefghi", columns, strict=True)},
        }
    )


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pieces of a part meet: its cells once, and of every piece which cells its tokens are."""
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            kind, packed = row["kind"], (row["a"], row["b"], row["c"])
            if kind in (_KINDS["hot"], _KINDS["docs"]):
                yield _stored(kind, row["part"], row["stretch"], "documents", packed)
            elif kind == _KINDS["counts"]:
                yield _stored(kind, row["part"], row["stretch"], "cells", packed)
            else:
                held.setdefault((kind, row["part"]), []).append((row["stretch"], packed, row["d"], row["e"]))
    while held:
        (kind, part), rows = held.popitem()
        packed, cells = _merge(kind, [r[1] for r in rows])
        yield _stored(kind, part, 0, "cells", packed)
        tokens = _KINDS["rare tokens"] if kind == _KINDS["rare"] else _KINDS["after tokens"]
        for (stretch, _, times, docs), cell in zip(rows, cells, strict=True):
            yield _stored(tokens, part, stretch, "tokens", (_pack(np.diff(cell, prepend=0).astype("<u4")), times, docs))


def stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers of ``c`` customers at ``t`` tables."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(1, most + 1):
        for t in range(1, c + 1):
            stay = table[c - 1, t] + np.log(c - 1 - t * discount) if c - 1 > t * discount and t < c else -np.inf
            table[c, t] = np.logaddexp(stay, table[c - 1, t - 1])
    return table


def sample_tables(
    customers: np.ndarray, base: np.ndarray, mass: np.ndarray, discount: float, rng: np.random.Generator, table: np.ndarray
) -> np.ndarray:
    """Numbers of tables drawn given ``base`` probabilities and ``mass`` = strength + discount * other tables."""
    tables = np.minimum(customers, 1).astype(np.int64)
    many = np.minimum(customers, EXACT)
    for c in np.unique(many[many > 1]).tolist():
        at = np.flatnonzero(many == c)
        t = np.arange(1, c + 1)
        grown = np.cumsum(np.log(mass[at, None] + discount * (t - 1)), axis=1)
        weight = table[c, 1 : c + 1] + t * np.log(base[at, None]) + grown
        weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        tables[at] = 1 + (weight < rng.random(len(at))[:, None] * weight[:, -1:]).sum(axis=1)
    at = np.flatnonzero(customers > EXACT)
    seated = np.full(len(at), EXACT, np.int64)
    while len(at):
        step = np.minimum(np.maximum(seated // 10, 1), customers[at] - seated)
        opened = (mass[at] + discount * tables[at]) * base[at]
        tables[at] += rng.binomial(step, np.clip(opened / (opened + seated - discount * tables[at]), 0, 1))
        seated += step
        left = seated < customers[at]
        at, seated = at[left], seated[left]
    return tables


def seat_restaurants(
    of: np.ndarray, counts: np.ndarray, base: np.ndarray, discount: float, rng: np.random.Generator, table: np.ndarray
) -> tuple[np.ndarray, float]:
    """Tables drawn in whole restaurants (``of`` each cell), their words in turns, and the strength that fits them best."""
    size = int(of.max()) + 1 if len(of) else 0
    customers = np.bincount(of, counts, size)
    tables = np.minimum(counts, 1).astype(np.int64)
    seated = np.bincount(of, tables, size)
    taken = np.flatnonzero(counts)
    own, lone, here = counts[taken], counts[taken] == 1, of[taken]
    left, others = np.maximum(own - 1 - discount, 0), discount * (seated[here] - lone)
    likelihoods = [
        (own * np.log((left + (s + others) * base[taken]) / (s + customers[here] - 1))).sum() for s in RARE_STRENGTHS
    ]
    strength = RARE_STRENGTHS[int(np.argmax(likelihoods))]
    many = np.flatnonzero(counts > 1)
    many = many[np.lexsort((rng.random(len(many)), of[many]))]
    runs = _runs(of[many])
    turn = (np.arange(len(many)) - np.repeat(runs, np.diff(np.append(runs, len(many))))) % TURNS
    turns = [many[turn == i] for i in range(TURNS)]
    for _ in range(SWEEPS):
        for at in turns:
            if len(at):
                mass = strength + discount * (seated[of[at]] - tables[at])
                drawn = sample_tables(counts[at], base[at], mass, discount, rng, table)
                np.add.at(seated, of[at], drawn - tables[at])
                tables[at] = drawn
    return tables, strength


class Model:
    """Totals of the restaurants that spread, and hyperparameters (root, classes, frequent words, rarer words)."""

    def __init__(self, hot: np.ndarray) -> None:
        self.hot = hot
        self.parent = np.concatenate([np.arange(CLASSES + 1), _class_of(hot)])
        self.discounts = [0.5, 0.5, 0.5, 0.5]
        self.strengths = [TOP_STRENGTH, 1.0, 1.0]
        n = len(self.parent)
        self.direct, self.tables = np.zeros(n), np.zeros(n)
        # Tables of frequent words in rarer words' restaurants, by class; their counts of one, of two, and tokens.
        self.rare = np.zeros((len(hot), CLASSES), np.int64)
        self.after = np.zeros(3)
        self.words = self.tokens = 0

    @property
    def stats(self) -> int:
        return 2 * len(self.parent) + 2 * 4 + 2 + len(STRENGTHS) ** 2

    def take(self, sums: np.ndarray) -> None:
        n = len(self.parent)
        self.direct, self.tables = sums[:n].copy(), sums[n : 2 * n]
        ones = sums[2 * n : 2 * n + 8].reshape(4, 2).copy()
        ones[3] += self.after[:2]
        self.discounts = [float(np.clip(a / max(a + 2 * b, 1), 0.05, 0.95)) for a, b in ones]
        self.words, self.tokens = sums[2 * n + 8], sums[2 * n + 9] + self.after[2]
        likelihood = sums[2 * n + 10 :]
        if likelihood.any():
            best = int(likelihood.argmax())
            self.strengths = [TOP_STRENGTH, STRENGTHS[best // len(STRENGTHS)], STRENGTHS[best % len(STRENGTHS)]]

    def take_after(self, found: dict[int, float]) -> None:
        sums = np.array([found.get(i, 0.0) for i in range(self.rare.size + 3)])
        self.rare, self.after = sums[:-3].astype(np.int64).reshape(self.rare.shape), sums[-3:]

    def grow(self, found: dict[int, float]) -> None:
        """More tables in rarer words' restaurants: of frequent words by class, and of all others by class."""
        sums = np.array([found.get(i, 0.0) for i in range(self.rare.size + CLASSES)])
        more = sums[: self.rare.size].astype(np.int64).reshape(self.rare.shape)
        self.rare = self.rare + more
        self.direct[:CLASSES] += more.sum(axis=0) + sums[self.rare.size :]

    def customers(self) -> np.ndarray:
        """Customers of every restaurant: its tokens and its children's tables."""
        below = np.bincount(self.parent[CLASSES + 1 :], self.tables[CLASSES + 1 :], CLASSES + 1)
        return self.direct + np.concatenate([below, np.zeros(len(self.parent) - CLASSES - 1)])

    def root(self) -> tuple[float, float]:
        """Customers of the root and the probability of an unknown word."""
        total = float(self.tables[: CLASSES + 1].sum())
        return total, (self.strengths[0] + self.discounts[0] * self.words) / (self.strengths[0] + total)


class Part:
    """The cells (word, context) of a part, and their seating."""

    def __init__(self, row: dict, model: Model) -> None:
        self.names, times = _words_once(row["a"])
        self.word = np.repeat(np.arange(len(self.names)), times)
        codes, before = _unpack_contexts(row["b"])
        self.context, self.count = codes.astype(np.int64), _unpack(row["c"], "<u4").astype(np.int64)
        self.train = np.bincount(self.word, self.count, len(self.names))
        self.model = model
        place, is_hot = _find(model.hot, self.names)
        self.is_hot = bool(is_hot.any())
        if self.is_hot:  # rarer words' restaurants lie elsewhere, only their tables count here
            word, of = np.nonzero(model.rare[place])
            self.word, self.context = np.append(self.word, word), np.append(self.context, of)
            self.count = np.append(self.count, model.rare[place[word], of])
        self.deep = np.flatnonzero(self.context > CLASSES)
        self.rare = np.flatnonzero(self.context < CLASSES)
        self.before = before[codes < CLASSES]
        keys, self.above = np.unique(self.word * (CLASSES + 1) + model.parent[self.context], return_inverse=True)
        self.class_word, self.class_context = keys // (CLASSES + 1), keys % (CLASSES + 1)
        # Everybody of a word at one table.
        self.tables = np.minimum(self.count[self.deep], 1)
        self.rare_tables = self.count[self.rare] if self.is_hot else np.minimum(self.count[self.rare], 1)
        self.rare_rest = self.rare_total = None
        self._come_in()
        self.class_tables = np.minimum(self.class_customers(), 1)

    def _come_in(self) -> None:
        """Customers of classes and of the start that come from no frequent word's restaurant."""
        start = self.context == START
        direct = np.bincount(self.above[start], self.count[start], len(self.class_word))
        self.direct = (direct + np.bincount(self.above[self.rare], self.rare_tables, len(self.class_word))).astype(np.int64)

    def asked(self, parts: int) -> list[tuple[int, np.ndarray]]:
        """The cells of rarer words' restaurants, by the part that seats them, sorted by the rarer word."""
        return list(_dealt(np.arange(len(self.rare)), self.before, np.arange(len(self.rare)), parts))

    def take_seats(self, replies: dict[int, dict], parts: int) -> None:
        self.rare_tables = np.zeros(len(self.rare), np.int64)
        self.rare_rest, self.rare_total = np.zeros(len(self.rare)), np.zeros(len(self.rare))
        for goes, at in self.asked(parts):
            self.rare_tables[at], self.rare_rest[at], self.rare_total[at] = _reply(replies[goes], self.before[at], self.model)
        self._come_in()
        self.class_tables = np.minimum(self.class_customers(), 1)

    def class_customers(self) -> np.ndarray:
        return self.direct + np.bincount(self.above[self.deep], self.tables, len(self.direct)).astype(np.int64)

    def root_customers(self) -> np.ndarray:
        return np.bincount(self.class_word, self.class_tables, len(self.names)).astype(np.int64)

    def root_probability(self) -> np.ndarray:
        total, unknown = self.model.root()
        customers = self.root_customers()
        return np.where(customers > 0, (customers - self.model.discounts[0]) / (self.model.strengths[0] + total), unknown)

    def class_probability(self) -> np.ndarray:
        m, d, s = self.model, self.model.discounts[1], self.model.strengths[1]
        own, total = self.class_customers() - d * self.class_tables, s + m.customers()[self.class_context]
        return (np.maximum(own, 0) + (s + d * m.tables[self.class_context]) * self.root_probability()[self.class_word]) / total

    def probability(self) -> np.ndarray:
        """Predictive probability of every cell."""
        m, d, s = self.model, self.model.discounts[2], self.model.strengths[2]
        out = self.class_probability()[self.above]
        context, count = self.context[self.deep], self.count[self.deep]
        own, total = np.maximum(count - d * self.tables, 0), s + m.customers()[context]
        out[self.deep] = (own + (s + d * m.tables[context]) * out[self.deep]) / total
        if self.rare_total is not None:
            own = np.maximum(self.count[self.rare] - m.discounts[3] * self.rare_tables, 0)
            out[self.rare] = (own + self.rare_rest * out[self.rare]) / self.rare_total
        return out

    def sweep(self, rng: np.random.Generator, tables: list[np.ndarray]) -> None:
        m = self.model
        context = self.context[self.deep]
        mass = m.strengths[2] + m.discounts[2] * np.maximum(m.tables[context] - self.tables, 0)
        base = self.class_probability()[self.above[self.deep]]
        self.tables = sample_tables(self.count[self.deep], base, mass, m.discounts[2], rng, tables[1])
        customers = self.class_customers()
        mass = m.strengths[1] + m.discounts[1] * np.maximum(m.tables[self.class_context] - self.class_tables, 0)
        base = self.root_probability()[self.class_word]
        self.class_tables = sample_tables(customers, base, mass, m.discounts[1], rng, tables[0])

    def sums(self, with_likelihood: bool) -> np.ndarray:
        n = len(self.model.parent)
        direct = np.bincount(self.context[self.deep], self.count[self.deep], n) + np.bincount(self.class_context, self.direct, n)
        tables = np.bincount(self.context[self.deep], self.tables, n) + np.bincount(self.class_context, self.class_tables, n)
        rare = np.zeros(0) if self.is_hot else self.count[self.rare]
        levels = self.root_customers(), self.class_customers(), self.count[self.deep], rare
        ones = [float((c == k).sum()) for c in levels for k in (1, 2)]
        grid = self._likelihoods() if with_likelihood else np.zeros(len(STRENGTHS) ** 2)
        return np.concatenate([direct, tables, ones, [float((self.root_customers() > 0).sum()), self.train.sum()], grid])

    def _likelihoods(self) -> np.ndarray:
        """Log-likelihood of tokens and of rarer words' tables, each left out once, for all pairs of strengths."""
        m = self.model
        below, (d1, d2) = m.customers(), m.discounts[1:3]
        root = self.root_probability()[self.class_word]
        own = np.maximum(self.class_customers() - 1 - d1, 0)
        out = []
        for s1 in STRENGTHS:
            of_class = (own + (s1 + d1 * m.tables[self.class_context]) * root) / (s1 + below[self.class_context])
            fixed = (self.direct * np.log(of_class)).sum()
            context, count, base = self.context[self.deep], self.count[self.deep], of_class[self.above[self.deep]]
            left = np.maximum(count - 1 - d2, 0)
            for s2 in STRENGTHS:
                p = (left + (s2 + d2 * m.tables[context]) * base) / (s2 + below[context])
                out.append(fixed + (count * np.log(p)).sum())
        return np.array(out)


def _tables(model: Model) -> list[np.ndarray]:
    return [stirling(EXACT, d) for d in model.discounts[1:3]]


def _seed(part: int, step: int) -> np.random.Generator:
    return np.random.default_rng([part, step])


def _pass(model: Model, sweeps: int, step: int, with_likelihood: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tables = np.zeros(model.stats), _tables(model)
        for batch in batches:
            for row in batch.to_pylist():
                part, rng = Part(row, model), _seed(row["part"], step)
                for _ in range(sweeps):
                    part.sweep(rng, tables)
                total += part.sums(with_likelihood)
        yield pa.record_batch({"place": np.arange(len(total)), "value": total})

    return run


def _gather(cells: DataFrame, model: Model, sweeps: int, step: int, with_likelihood: bool = False) -> None:
    """One pass over all cells; the restaurants' totals, a bounded list, come back to the model."""
    sums = cells.mapInArrow(_pass(model, sweeps, step, with_likelihood), "place long, value double")
    found = {row.place: row.value for row in sums.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    model.take(np.array([found.get(i, 0.0) for i in range(model.stats)]))


def _collected(places: DataFrame) -> dict[int, float]:
    return {row.place: row.value for row in places.groupBy("place").agg(F.sum("value").alias("value")).collect()}


def _sparse(values: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(values)
    return pa.record_batch({"place": pa.array(at, pa.int64()), "value": values[at].astype(np.float64)})


def _counted_after(model: Model):
    """Frequent words after rarer ones: cells by word and class, counts of one and two, and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(model.rare.size + 3)
        for batch in batches:
            for row in batch.to_pylist():
                words, place, counts = _words_of(row["a"]), _unpack_contexts(row["b"])[0], _unpack(row["c"], "<u4")
                seen = counts > 0
                total[:-3] += np.bincount(place[seen].astype(np.int64) * CLASSES + _class_of(words[seen]), minlength=model.rare.size)
                total[-3:] += (counts == 1).sum(), (counts == 2).sum(), counts.sum()
        yield _sparse(total)

    return run


def _predict_hot(model: Model):
    """Averaged probabilities of frequent words in every restaurant that spreads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(model)
        for batch in batches:
            for row in batch.to_pylist():
                part, rng = Part(row, model), _seed(row["part"], 0xFFFF)
                place, _ = _find(model.hot, part.names)
                mean = np.zeros((len(place), len(model.parent)))
                for i in range(SWEEPS + SAMPLES):
                    part.sweep(rng, tables)
                    if i >= SWEEPS:
                        for word in range(len(place)):
                            mean[word] += _everywhere(part, word) / SAMPLES
                yield pa.record_batch({"place": pa.array(place, pa.int64()), "line": [m.astype("<f8").tobytes() for m in mean]})

    return run


def hot_table(hot_cells: DataFrame, model: Model) -> np.ndarray:
    """Probability of each frequent word in each restaurant that spreads, a table bounded by their numbers."""
    table = np.ones((len(model.hot), len(model.parent)))
    for row in hot_cells.mapInArrow(_predict_hot(model), "place long, line binary").toLocalIterator():
        table[row.place] = np.frombuffer(row.line, "<f8")
    return table


def _requests(model: Model, parts: int):
    """Customers of rarer words' restaurants, to the part of that word, with their probability in its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(model)
        for batch in batches:
            for row in batch.to_pylist():
                part, rng = Part(row, model), _seed(row["part"], 0xFFFE)
                for _ in range(SWEEPS):
                    part.sweep(rng, tables)
                base, counts = part.class_probability()[part.above[part.rare]], part.count[part.rare]
                for goes, at in part.asked(parts):
                    yield pa.record_batch(
                        {
                            "goes": pa.array([goes], pa.int64()),
                            "comes": pa.array([row["part"]], pa.int64()),
                            "a": [_pack_words(part.before[at])],
                            "b": [_pack(counts[at].astype("<u4"))],
                            "c": [_pack(base[at[counts[at] > 1]].astype("<f4"))],
                        }
                    )

    return run


def _seats(model: Model, classes: np.ndarray):
    """Rarer words' restaurants meet, are seated, and go back to the parts of their customers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = stirling(EXACT, model.discounts[3])
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["goes"], []).append(row)
        while held:
            goes, rows = held.popitem()
            yield from _seat(goes, sorted(rows, key=lambda r: r["comes"]), model, classes, table)

    return run


def _seat(goes: int, rows: list[dict], model: Model, classes: np.ndarray, table: np.ndarray) -> Iterator[pa.RecordBatch]:
    names, times, counts, bases, cells = [], [], [], [], []
    for row in rows:
        words, n = _words_once(row["a"])
        of = np.repeat(_class_of(words), n)
        names.append(words)
        times.append(n)
        if row["comes"] < 0:
            place = _unpack_contexts(row["b"])[0].astype(np.int64)
            counts.append(_unpack(row["c"], "<u4").astype(np.int64))
            bases.append(classes[place, of])
            cells.append(place * CLASSES + of)
        else:
            counts.append(_unpack(row["b"], "<u4").astype(np.int64))
            # A single customer has one table, whatever its base; that is the same factor for all strengths.
            base = np.ones(len(counts[-1]))
            base[counts[-1] > 1] = _unpack(row["c"], "<f4")
            bases.append(base)
            cells.append(model.rare.size + of)
    which = np.unique(np.concatenate(names), return_inverse=True)[1]
    of = np.repeat(which, np.concatenate(times))
    count = np.concatenate(counts)
    tables, strength = seat_restaurants(of, count, np.concatenate(bases), model.discounts[3], _seed(goes, 0xFFFD), table)
    customers, seated = np.bincount(of, count).astype("<i8"), np.bincount(of, tables).astype("<i8")
    first = cell = 0
    for row, words, own in zip(rows, names, counts, strict=True):
        mine = which[first : first + len(words)]
        kind, part = (_AFTER_SEATS, goes) if row["comes"] < 0 else (_SEATS, row["comes"])
        packed = customers[mine], seated[mine], tables[cell : cell + len(own)].astype("<u4"), np.array([strength], "<f8")
        yield _seat_row(kind, part, goes, packed)
        first, cell = first + len(words), cell + len(own)
    more = tables - np.minimum(count, 1)
    grown = np.bincount(np.concatenate(cells), more, model.rare.size + CLASSES)
    at = np.flatnonzero(grown)
    yield _seat_row(_GROWN, goes, goes, (at.astype("<i8"), grown[at].astype("<f8"), np.zeros(0), np.zeros(0)))


def _seat_row(kind: int, part: int, goes: int, packed: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "kind": pa.array([kind], pa.int32()),
            "part": pa.array([part], pa.int64()),
            "stretch": pa.array([goes], pa.int64()),
            **{name: [_pack(array)] for name, array in zip("abcd", packed, strict=True)},
        }
    )


def _reply(row: dict, before: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of cells sorted by the word before: tables, what is left for the class, and the customers, both with the strength."""
    times = np.diff(np.append(_runs(before), len(before)))
    customers, seated, strength = _unpack(row["a"], "<i8"), _unpack(row["b"], "<i8"), _unpack(row["d"], "<f8")[0]
    rest = strength + model.discounts[3] * seated
    return _unpack(row["c"], "<u4").astype(np.int64), np.repeat(rest, times), np.repeat(strength + customers, times)


def _grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield pa.record_batch({"place": _unpack(row["a"], "<i8"), "value": _unpack(row["b"], "<f8")})


def _everywhere(part: Part, word: int) -> np.ndarray:
    """Probability of a word in every restaurant."""
    m = part.model
    below = m.customers()
    root = part.root_probability()[word]
    first, last = np.searchsorted(part.class_word, [word, word + 1])
    own = np.zeros(CLASSES + 1)
    customers = part.class_customers()[first:last] - m.discounts[1] * part.class_tables[first:last]
    own[part.class_context[first:last]] = np.maximum(customers, 0)
    s, d = m.strengths[1], m.discounts[1]
    classes = (own + (s + d * m.tables[: CLASSES + 1]) * root) / (s + below[: CLASSES + 1])
    first, last = np.searchsorted(part.word[part.deep], [word, word + 1])
    own = np.zeros(len(m.parent))
    count = part.count[part.deep][first:last] - m.discounts[2] * part.tables[first:last]
    own[part.context[part.deep][first:last]] = np.maximum(count, 0)
    s, d = m.strengths[2], m.discounts[2]
    deep = slice(CLASSES + 1, None)
    words = (own[deep] + (s + d * m.tables[deep]) * classes[m.parent[deep]]) / (s + below[deep])
    return np.concatenate([classes, words])


def _base(train: np.ndarray, model: Model) -> np.ndarray:
    return np.log10((train + 0.5) / (model.tokens + 0.5 * (model.words + 1)))


_SUMS = "kind int, stretch long, a binary, b binary, c binary, d binary"


def _sums(stretch: int, doc: np.ndarray, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    """Sums over the tokens of each document of a stretch, packed."""
    docs, doc = np.unique(doc, return_inverse=True)
    sums = [np.bincount(doc, x, len(docs)) for x in (known, base, score)]
    return pa.record_batch(
        {
            "kind": pa.array([_KINDS["rare"]], pa.int32()),
            "stretch": pa.array([stretch], pa.int64()),
            "a": [_pack(docs.astype("<u4"))],
            "b": [_pack(sums[0].astype("<i8"))],
            "c": [_pack(sums[1])],
            "d": [_pack(sums[2])],
        }
    )


class _Scores:
    """Of every cell of a part: the score, and of its word the base score and whether it is known."""

    def __init__(self, scores: np.ndarray, which: np.ndarray, bases: np.ndarray, known: np.ndarray) -> None:
        self.scores, self.which, self.bases, self.known = scores.astype(np.float32), which, bases, known

    def of_tokens(self, row: dict) -> tuple[np.ndarray, ...]:
        """Documents of a piece's tokens, whether they are known, base scores and scores."""
        cell, times = np.cumsum(_unpack(row["d"], "<u4"), dtype=np.int64), _unpack(row["e"], "<u4")
        word, doc = self.which[cell], _unpack(row["f"], "<u4")
        found = self.known[word].astype(np.float64), self.bases[word], self.scores[cell].astype(np.float64)
        return doc, *(np.repeat(x, times) for x in found)


def _after_scores(row: dict, model: Model, classes: np.ndarray, bases: np.ndarray) -> _Scores:
    """Frequent words after the rarer words of a part."""
    words, (place, _) = _words_of(row["a"]), _unpack_contexts(row["b"])
    (reply,) = (r for r in row["seats"] if r["kind"] == _AFTER_SEATS)
    tables, rest, total = _reply(reply, words, model)
    own = np.maximum(_unpack(row["c"], "<u4") - model.discounts[3] * tables, 0)
    scores = np.log10((own + rest * classes[place, _class_of(words)]) / total)
    return _Scores(scores, place, bases, np.ones(len(bases)))


def _rare_scores(row: dict, model: Model, parts: int, tables: list[np.ndarray]) -> _Scores:
    """The rarer words of a part, after any word."""
    part, rng = Part(row, model), _seed(row["part"], 0xFFFF)
    part.take_seats({r["stretch"]: r for r in row["seats"] or [] if r["kind"] == _SEATS}, parts)
    mean = np.zeros(len(part.count))
    for i in range(SWEEPS + SAMPLES):
        part.sweep(rng, tables)
        if i >= SWEEPS:
            mean += part.probability() / SAMPLES
    return _Scores(np.log10(mean), part.word.astype(np.int32), _base(part.train, model), part.train > 0)


def _score_parts(model: Model, parts: int, classes: np.ndarray, bases: np.ndarray):
    """A part's cells come first, then its tokens by their stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(model)
        scores: dict[int, _Scores] = {}
        at, found = None, []
        for batch in batches:
            for row in batch.to_pylist():
                kind, here = row["kind"], (row["part"], row["stretch"])
                if found and here != at:
                    yield _sums(at[1], *(np.concatenate(x) for x in zip(*found, strict=True)))
                    found = []
                if at is None or at[0] != row["part"]:
                    scores = {}
                at = here
                if kind == _KINDS["rare"]:
                    scores[_KINDS["rare tokens"]] = _rare_scores(row, model, parts, tables)
                elif kind == _KINDS["after"]:
                    scores[_KINDS["after tokens"]] = _after_scores(row, model, classes, bases)
                else:
                    found.append(scores[kind].of_tokens(row))
        if found:
            yield _sums(at[1], *(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _score_hot(model: Model, scores: np.ndarray, train: np.ndarray):
    bases = _base(train, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc, place, context = _unpack(row["g"], "<u4"), _unpack(row["h"], "<u2"), _unpack(row["i"], "<u2")
                score = scores[place, context].astype(np.float64) if len(doc) else np.zeros(0)
                yield _sums(row["stretch"], doc, np.ones(len(doc)), bases[place] if len(doc) else np.zeros(0), score)

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All sums of a stretch of documents meet and become rows."""
    names: dict[int, dict] = {}
    totals: dict[int, np.ndarray] = {}
    waiting: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            stretch = row["stretch"]
            if row["kind"] == _KINDS["docs"]:
                names[stretch] = row
                totals[stretch] = np.zeros((3, len(_unpack(row["a"], "<i8"))))
                for early in waiting.pop(stretch, []):
                    _add(totals[stretch], early)
            elif stretch in totals:
                _add(totals[stretch], row)
            else:
                waiting.setdefault(stretch, []).append(row)
    for stretch, row in names.items():
        ids, flags = _unpack(row["a"], "<i8"), _unpack(row["b"], "u1")
        known, base, score = totals[stretch]
        yield pa.record_batch(
            {
                "doc_id": pa.array(ids, mask=(flags & 1) == 0),
                "held_out": pa.array((flags & 2) > 0),
                "n_tokens": pa.array(_unpack(row["c"], "<i8")),
                "n_known": pa.array(known.astype(np.int64)),
                "base_score": base,
                "score": score,
            }
        )


def _add(totals: np.ndarray, row: dict) -> None:
    docs = _unpack(row["a"], "<u4")
    for line, name, kind in ((0, "b", "<i8"), (1, "c", "<f8"), (2, "d", "<f8")):
        totals[line, docs] += _unpack(row[name], kind)


def _in_buckets(rows: DataFrame, parts: int) -> DataFrame:
    """Written once as Spark buckets by part, so that a join by part leaves the rows where they are."""
    spark = rows.sparkSession
    name = f"docsink_{uuid.uuid4().hex}"
    path = f"{work_dir(spark, 'tokens')}/tokens"
    writer = rows.write.bucketBy(parts, "part").option("path", path).option("compression", "zstd")
    writer.saveAsTable(name, format="parquet")
    # The files stay; only the name was needed, to tell Spark of the buckets.
    table = spark.table(name)
    table.schema  # noqa: B018  resolves the table
    spark.sql(f"drop table {name}")
    return table


def train_model(docs: DataFrame, text: str = "text") -> tuple[Model, DataFrame, tuple[DataFrame, DataFrame, DataFrame, np.ndarray], int]:
    """The model, the packed cells and tokens of all documents, and of all parts: the cells of rarer and (parts from
    ``parts`` on) of frequent words, the cells of frequent words after rarer ones, the seats of rarer words' restaurants,
    and how often the frequent words occur."""
    size = F.sum(F.octet_length(text_of(text))).alias("n")
    tokens = (docs.agg(size).first().n or 0) // 6 + 1
    parts = int(min(max(-(-tokens // PART_TOKENS), LEAST_PARTS), MOST_PARTS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), text_of(text).alias("text"))
    hot, train = hot_words(rows, parts)
    pieces = rows.mapInArrow(_occurrences(hot, parts), _PIECES).repartition(parts, "part")
    packed = _in_buckets(pieces.mapInArrow(_together, _PACKED), parts)
    cell = "part long, a binary, b binary, c binary"
    hot_cells = packed.where(F.col("kind") == _KINDS["counts"]).select("part", "a", "b", "c")
    hot_cells = written(hot_cells.mapInArrow(_cells_of_pieces, cell).repartition(HOT_PARTS, "part").mapInArrow(_merged, cell), "cells")
    rare_cells, after = (packed.where(F.col("kind") == _KINDS[k]).select("part", "a", "b", "c") for k in ("rare", "after"))
    cells = rare_cells.unionByName(hot_cells)
    model = Model(hot)
    model.take_after(_collected(after.mapInArrow(_counted_after(model), "place long, value double")))
    _gather(cells, model, 0, 0)
    _gather(cells, model, 0, 1, with_likelihood=True)
    for step in range(EXCHANGES):
        _gather(cells, model, SWEEPS, 2 + step)
    request = "goes long, comes long, a binary, b binary, c binary"
    own = after.select(F.col("part").alias("goes"), F.lit(-1).cast("long").alias("comes"), "a", "b", "c")
    asked = rare_cells.mapInArrow(_requests(model, parts), request).unionByName(own).repartition(parts, "goes")
    classes = hot_table(hot_cells, model)[:, :CLASSES]
    seats = "kind int, part long, stretch long, a binary, b binary, c binary, d binary"
    seats = written(asked.mapInArrow(_seats(model, classes), seats), "seats")
    model.grow(_collected(seats.where(F.col("kind") == _GROWN).mapInArrow(_grown, "place long, value double")))
    return model, packed, (cells, after, seats, train), parts


def lm_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    model, packed, (cells, _, seats, train), parts = train_model(docs, text)
    table = hot_table(cells.where(F.col("part") >= parts), model)
    # In as many partitions as there are buckets, or Spark would shuffle the tokens instead.
    of_part = seats.where(F.col("kind") != _GROWN).repartition(parts, "part").groupBy("part")
    of_part = of_part.agg(F.collect_list(F.struct("kind", "stretch", "a", "b", "c", "d")).alias("seats"))
    is_tokens = F.col("kind").isin(_KINDS["rare tokens"], _KINDS["after tokens"])
    rows = packed.where(is_tokens | F.col("kind").isin(_KINDS["rare"], _KINDS["after"])).drop("g", "h", "i")
    rows = rows.join(of_part.hint("shuffle_hash"), "part", "left").withColumn("seats", F.when(~is_tokens, F.col("seats")))
    rows = rows.sortWithinPartitions("part", is_tokens, "stretch", "kind")
    rare = rows.mapInArrow(_score_parts(model, parts, table[:, :CLASSES], _base(train, model)), _SUMS)
    scores = np.log10(table).astype(np.float32)
    documents = packed.select("kind", "stretch", "g", "h", "i")
    hot = documents.where(F.col("kind") == _KINDS["hot"]).mapInArrow(_score_hot(model, scores, train), _SUMS)
    documents = documents.where(F.col("kind") == _KINDS["docs"])
    documents = documents.select("kind", "stretch", *(F.col(x).alias(y) for x, y in zip("ghi", "abc", strict=True)), F.lit(None).cast("binary").alias("d"))
    sums = rare.unionByName(hot).unionByName(documents).repartition("stretch")
    scored = sums.mapInArrow(
        _totals, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    trained = F.lit(int(model.tokens)).cast("long").alias("train_tokens")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", trained, "base_score", "score")
