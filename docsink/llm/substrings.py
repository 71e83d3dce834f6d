"""Removal of repeated passages by recompression (operator 12).

A word goes if some window of ``WINDOW`` consecutive words around it also starts
earlier: in a document of smaller ``doc_id``, or further up in the same one.

Recompression rewrites all texts in rounds. A round replaces pairs of adjacent
symbols, the first with a coin of 0 and the second with a coin of 1, by one
symbol each; from round ``ANCHOR_ROUNDS`` on, runs of one symbol are replaced
first. Coins and names are hashed from the symbols themselves, so a run or a
pair has the same name in every task and in every round without an exchange,
and equal passages are rewritten alike except near their ends. Spark's exchanges
then find out which names are shared:

1. *Nodes* are symbols of later rounds that stand for ``WINDOW`` words or more.
   All occurrences of a name but the first are repeats as a whole, which settles
   most of what long copies hold.
2. *Anchors* are the symbols after ``ANCHOR_ROUNDS`` rounds, some three words
   long, with the stretch of words that decided about them: both neighbours only
   matter where a coin leaves it open. A window that holds the stretch of an
   anchor holds that anchor wherever the window occurs. So a window with an
   anchor that occurs once is unique, and all other windows are candidates, also
   those that hold no whole stretch.
3. Candidates are compared exactly (as far as 96-bit hashes of their words are
   exact); of equal windows all but the first are repeats.

Texts are written once, in chunks of some thousand documents, as Spark buckets;
answers are joined to the chunks without shuffling a text. What is exchanged is
packed: each chunk sends one row per part of the hash range, with its repeats
inside the chunk left out, so that even a passage in all documents comes to one
entry per chunk. Parts grow in number with the texts.

Defined results: a null or empty text has no words; rows of equal ``doc_id``
count in the order in which they are read, and rows without ``doc_id`` before all
others; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsink.llm.common import mix64, text_of, written
from docsink.llm.words import Words, pieces, split_words
from docsink.plans.tables import work_dir

WINDOW = 20
ANCHOR_ROUNDS = 4
LAST_ROUND = 64
NODE_ROUNDS = 4  # nodes are taken every so many rounds
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 50_000
PART_BYTES = 24 << 20  # of text, whose packed symbols one part takes

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # odd
_FAR = np.int64(1 << 60)
_ENTRY = 24  # bytes: key, doc_id, check, position
_NO_DOC = np.int64(-(1 << 63))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, texts in pieces(batch, 2, CHUNK_BYTES):
            doc_id = piece.column(1)
            order = np.argsort(doc_id.fill_null(int(_NO_DOC)).to_numpy(), kind="stable")
            yield pa.record_batch(
                {
                    "chunk": piece.column(0).slice(0, 1),
                    "doc_id": pa.array([doc_id.take(pa.array(order)).to_pylist()], pa.list_(pa.int64())),
                    "text": pa.array([[texts[i] for i in order]], pa.list_(pa.binary())),
                }
            )


class _Bucketed:
    """Chunks of documents, written as buckets so that joins leave them where they are."""

    def __init__(self, docs: DataFrame, text: str) -> None:
        rows = docs.select(
            F.monotonically_increasing_id().alias("chunk"),
            F.col("doc_id").cast("long").alias("doc_id"),
            text_of(text).cast("binary").alias("text"),
        )
        self.bytes = docs.agg(F.sum(F.octet_length(text_of(text)))).first()[0] or 0
        buckets = min(max(1, -(-self.bytes // BUCKET_BYTES)), MAX_BUCKETS)
        chunks = rows.mapInArrow(_chunks, "chunk long, doc_id array<long>, text array<binary>")
        spark = docs.sparkSession
        name = f"docsink_{uuid.uuid4().hex}"
        path = f"{work_dir(spark, 'chunks')}/chunks"
        writer = chunks.write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd")
        writer.saveAsTable(name, format="parquet")
        # The files stay; only the name was needed, to tell Spark of the buckets.
        self.rows = spark.table(name)
        self.rows.schema  # noqa: B018  resolves the table
        spark.sql(f"drop table {name}")
        self.parts = max(1, -(-self.bytes // PART_BYTES))

    def with_answers(self, *answers: DataFrame) -> DataFrame:
        """Chunks with the answers to several questions, ``answer0, answer1 ...``."""
        joined = self.rows
        for number, answer in enumerate(answers):
            named = answer.withColumnRenamed("answers", f"answer{number}")
            joined = joined.join(named.hint("shuffle_hash"), "chunk", "left")
        return joined


class _Chunk:
    """Words and symbols of a chunk; the same in every pass."""

    def __init__(self, texts: list[bytes], window: int) -> None:
        self.window = window
        self.words: Words = split_words(texts)
        self.numbers = self.words.numbers()
        self.doc = self.words.doc
        self.n = len(self.doc)
        first = self.words.first
        long = np.diff(first) >= window
        # Documents shorter than a window have nothing to compare.
        at = np.flatnonzero(long[self.doc]) if self.n else np.zeros(0, np.int64)
        symbols = (self.numbers[at], at, at + 1, self.doc[at])
        low, high = at, at + 1
        for number in range(1, ANCHOR_ROUNDS + 1):
            symbols, low, high = _pair_round(number, symbols, low, high)
        safe = (low >= 0) & (high - low <= window)
        self.anchors = symbols[0][safe]
        self.low, self.high = low[safe], high[safe]
        self.nodes, self.start, self.end = _nodes(symbols, window)
        self.is_window = np.zeros(self.n, bool)
        if self.n >= window:
            self.is_window[: self.n - window + 1] = self.doc[: self.n - window + 1] == self.doc[window - 1 :]

    def node_checks(self) -> np.ndarray:
        """A second hash of the words of each node, so that 96 bits tell nodes apart."""
        base = _BASE[0]
        with np.errstate(over="ignore"):
            up = np.cumprod(np.full(self.n, base, np.uint64))
            down = np.cumprod(np.full(self.n, pow(base, -1, 1 << 64), np.uint64))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(self.numbers) * up)])
            return mix64((sums[self.end] - sums[self.start]) * down[self.start])

    def window_hashes(self, base: int) -> np.ndarray:
        """Hashes of the words of all windows, by joining shorter windows to ones of twice the length."""
        result, done = np.zeros(self.n, np.uint64), 0
        part, width, power = self.numbers, 1, base
        left = self.window
        with np.errstate(over="ignore"):
            while left:
                if left & 1:
                    # The next ``width`` words follow those that are hashed already.
                    shifted = np.zeros(self.n, np.uint64)
                    shifted[: self.n - done] = part[done:]
                    result = result * np.uint64(power) + shifted
                    done += width
                following = np.zeros(self.n, np.uint64)
                following[: max(self.n - width, 0)] = part[width:]
                part = part * np.uint64(power) + following
                width, power, left = 2 * width, power * power % (1 << 64), left >> 1
        return mix64(result)

    def covered(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which words lie in any of the stretches."""
        change = np.bincount(start, minlength=self.n + 1) - np.bincount(end, minlength=self.n + 1)
        return np.cumsum(change[: self.n]) > 0

    def candidates(self, repeated_nodes: np.ndarray, shared_anchors: np.ndarray) -> np.ndarray:
        """Starts of windows that neither lie in a repeated node nor hold an anchor that occurs once."""
        window = self.window
        start, end = self.start[repeated_nodes], self.end[repeated_nodes]
        settled = self.covered(start, end - window + 1)
        alone = ~shared_anchors
        unique = self.covered(np.maximum(self.high[alone] - window, 0), self.low[alone] + 1)
        return np.flatnonzero(self.is_window & ~settled & ~unique)


def _pair_round(
    number: int,
    symbols: tuple[np.ndarray, ...],
    low: np.ndarray | None = None,
    high: np.ndarray | None = None,
) -> tuple[tuple[np.ndarray, ...], np.ndarray | None, np.ndarray | None]:
    """Replace pairs by one symbol each; ``low, high`` are the words that decided about a symbol."""
    name, start, end, doc = symbols
    n = len(name)
    with np.errstate(over="ignore"):
        right = (mix64(name + np.uint64(number) * _GOLDEN) >> np.uint64(63)).astype(bool)
    adjacent = np.zeros(n, bool)
    adjacent[:-1] = doc[:-1] == doc[1:]
    opens = np.zeros(n, bool)
    opens[:-1] = ~right[:-1] & right[1:] & adjacent[:-1]
    closes = np.zeros(n, bool)
    closes[1:] = opens[:-1]
    first = np.flatnonzero(opens)
    kept = ~closes
    if low is not None:
        # A symbol that stays alone does so because of one neighbour: the one its
        # coin would have joined it to. Where the text ends, another text may go on.
        follows = np.zeros(n, bool)
        follows[1:] = adjacent[:-1]
        new_low, new_high = low.copy(), high.copy()
        alone = kept & ~opens
        i = np.flatnonzero(alone & right & follows)
        new_low[i] = low[i - 1]
        new_low[alone & right & ~follows] = -_FAR
        i = np.flatnonzero(alone & ~right & adjacent)
        new_high[i] = high[i + 1]
        new_high[alone & ~right & ~adjacent] = _FAR
        low, high = np.minimum(new_low, low), np.maximum(new_high, high)
        low[first] = np.minimum(low[first], low[first + 1])
        high[first] = np.maximum(high[first], high[first + 1])
        low, high = low[kept], high[kept]
    name, end = name.copy(), end.copy()
    with np.errstate(over="ignore"):
        name[first] = mix64(mix64(name[first]) + mix64(name[first + 1] + _GOLDEN) * _GOLDEN)
    end[first] = end[first + 1]
    return (name[kept], start[kept], end[kept], doc[kept]), low, high


def _run_round(symbols: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Replace runs of one symbol by one symbol each."""
    name, start, end, doc = symbols
    again = np.zeros(len(name), bool)
    again[1:] = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
    if not again.any():
        return symbols
    begin = np.flatnonzero(~again)
    times = np.diff(np.append(begin, len(name)))
    named = name[begin]
    several = times > 1
    with np.errstate(over="ignore"):
        named[several] = mix64(mix64(named[several]) + times[several].astype(np.uint64) * _GOLDEN)
    return named, start[begin], end[begin + times - 1], doc[begin]


def _nodes(symbols: tuple[np.ndarray, ...], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``name, start, end`` of symbols of later rounds with a window's words or more."""
    taken = []
    for number in range(ANCHOR_ROUNDS + 1, LAST_ROUND + 1):
        if not len(symbols[0]):
            break
        symbols, _, _ = _pair_round(number, _run_round(symbols))
        name, start, end, doc = symbols
        edge = np.concatenate([[True], doc[1:] != doc[:-1], [True]])
        whole = edge[:-1] & edge[1:]  # the only symbol left of its text
        take = (end - start >= window) & (whole | (number % NODE_ROUNDS == 0))
        taken.append((name[take], start[take], end[take]))
        symbols = tuple(column[~whole] for column in symbols)
    if not taken:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    name, start, end = (np.concatenate(column) for column in zip(*taken, strict=True))
    # A symbol that did not change between two rounds is one node.
    order = np.lexsort((end, start))
    name, start, end = name[order], start[order], end[order]
    new = np.ones(len(name), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return name[new], start[new], end[new]


def _first_of_equals(key: np.ndarray, check: np.ndarray) -> np.ndarray:
    """For entries in order, which have no equal before them."""
    _, first, group = np.unique(key, return_index=True, return_inverse=True)
    leader = first[group]
    return (leader == np.arange(len(key))) | (check != check[leader])


def _entries(key: np.ndarray, doc_id: np.ndarray, check: np.ndarray, position: np.ndarray) -> bytes:
    small = (check >> np.uint64(32)).astype(np.uint32)
    return b"".join([key.tobytes(), doc_id.tobytes(), small.tobytes(), position.astype(np.int32).tobytes()])


def _by_part(key: np.ndarray, parts: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order of the keys by part, and ``(part, begin, end)`` in that order."""
    part = (key >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    which, begin = np.unique(part[order], return_index=True)
    ends = np.append(begin, len(order))[1:].tolist()
    return order, list(zip(which.tolist(), begin.tolist(), ends, strict=True))


def _read(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[dict, np.ndarray, _Chunk]]:
    """Rows of chunks with what was computed from their texts; ``doc_id`` of each word."""
    for batch in batches:
        for i in range(len(batch)):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            chunk = _Chunk([t.as_py() for t in row["text"]], window)
            ids = np.array([_NO_DOC if d is None else d for d in row["doc_id"].as_py()], np.int64)
            yield row, ids[chunk.doc] if chunk.n else np.zeros(0, np.int64), chunk


def _told(answers: pa.Scalar, which: str, sizes: list[tuple[int, int, int]], order: np.ndarray) -> np.ndarray:
    """Answers of all parts as one flag per entry, in the order of the entries."""
    flags = np.zeros(len(order), bool)
    given = {a["part"]: a[which] for a in answers.as_py() or []}
    for part, begin, end in sizes:
        flags[order[begin:end]] = np.unpackbits(np.frombuffer(given[part], np.uint8), count=end - begin).astype(bool)
    return flags


def _symbol_rows(parts: int, window: int):
    """First pass: nodes and anchors of each chunk, without their repeats inside the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, chunk in _read(batches, window):
            rows: dict[int, list[bytes]] = {}
            check = chunk.node_checks()
            sent = np.flatnonzero(_first_of_equals(chunk.nodes, check))
            key = chunk.nodes[sent]
            order, sizes = _by_part(key, parts)
            for part, begin, end in sizes:
                at = sent[order[begin:end]]
                packed = _entries(chunk.nodes[at], ids[chunk.start[at]], check[at], chunk.start[at])
                rows.setdefault(part, [b"", b""])[0] = packed
            names = np.unique(chunk.anchors)
            order, sizes = _by_part(names, parts)
            for part, begin, end in sizes:
                rows.setdefault(part, [b"", b""])[1] = names[order[begin:end]].tobytes()
            if rows:
                yield _packed_rows(row["chunk"].as_py(), rows)

    return run


def _packed_rows(chunk: int, rows: dict[int, list[bytes]]) -> pa.RecordBatch:
    return pa.record_batch(
        {
            "part": pa.array(list(rows), pa.int32()),
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "entries": pa.array([r[0] for r in rows.values()], pa.binary()),
            "names": pa.array([r[1] for r in rows.values()], pa.binary()),
        }
    )


_PACKED = "part int, chunk long, entries binary, names binary"


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner of some parts: which entries have an equal before them, which names occur in several chunks."""
    part, chunk, sizes, counts = [], [], [], []
    columns: list[list[np.ndarray]] = [[], [], [], []]
    names = []
    for batch in batches:
        for row in batch.to_pylist():
            part.append(row["part"])
            chunk.append(row["chunk"])
            packed = row["entries"]
            n = len(packed) // _ENTRY
            sizes.append(n)
            columns[0].append(np.frombuffer(packed, np.uint64, n))
            columns[1].append(np.frombuffer(packed, np.int64, n, 8 * n))
            columns[2].append(np.frombuffer(packed, np.uint32, n, 16 * n))
            columns[3].append(np.frombuffer(packed, np.int32, n, 20 * n))
            names.append(np.frombuffer(row["names"], np.uint64))
            counts.append(len(names[-1]))
    if not part:
        return
    key, doc_id, check, position = (np.concatenate(c) for c in columns)
    of = np.repeat(np.array(chunk, np.int64), sizes)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    several = np.append(same, False) | np.append(False, same)
    order = order[several]
    order = order[np.lexsort((position[order], of[order], doc_id[order], check[order], key[order]))]
    repeated = np.zeros(len(key), bool)
    equal = (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])
    repeated[order[1:][equal]] = True

    name = np.concatenate(names)
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    shared = np.zeros(len(name), bool)
    shared[order] = np.append(same, False) | np.append(False, same) if len(name) else False

    def bits(flags: np.ndarray, lengths: list[int]) -> list[bytes]:
        stops = np.cumsum(lengths).tolist()
        return [np.packbits(flags[b - n : b]).tobytes() for b, n in zip(stops, lengths, strict=True)]

    yield pa.record_batch(
        {
            "part": pa.array(part, pa.int32()),
            "chunk": pa.array(chunk, pa.int64()),
            "repeated": pa.array(bits(repeated, sizes), pa.binary()),
            "shared": pa.array(bits(shared, counts), pa.binary()),
        }
    )


_ANSWER = "part int, chunk long, repeated binary, shared binary"


def _candidates(row: dict, chunk: _Chunk, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes are repeats, and the windows to compare, by the first answers."""
    first = _first_of_equals(chunk.nodes, chunk.node_checks())
    sent = np.flatnonzero(first)
    order, sizes = _by_part(chunk.nodes[sent], parts)
    repeated = ~first
    repeated[sent] = _told(row["answer0"], "repeated", sizes, order)
    names, place, count = np.unique(chunk.anchors, return_inverse=True, return_counts=True)
    order, sizes = _by_part(names, parts)
    shared = (_told(row["answer0"], "shared", sizes, order) | (count > 1))[place]
    return repeated, chunk.candidates(repeated, shared)


def _window_keys(chunk: _Chunk, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return chunk.window_hashes(_BASE[0])[at], chunk.window_hashes(_BASE[1])[at]


def _window_rows(parts: int, window: int):
    """Second pass: candidates of each chunk, without their repeats inside the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, ids, chunk in _read(batches, window):
            _, at = _candidates(row, chunk, parts)
            key, check = _window_keys(chunk, at)
            sent = np.flatnonzero(_first_of_equals(key, check))
            order, sizes = _by_part(key[sent], parts)
            rows = {}
            for part, begin, end in sizes:
                i = sent[order[begin:end]]
                rows[part] = [_entries(key[i], ids[at[i]], check[i], at[i]), b""]
            if rows:
                yield _packed_rows(row["chunk"].as_py(), rows)

    return run


def _kept_rows(parts: int, window: int):
    """Last pass: the words that stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, chunk in _read(batches, window):
            repeated, at = _candidates(row, chunk, parts)
            key, check = _window_keys(chunk, at)
            first = _first_of_equals(key, check)
            sent = np.flatnonzero(first)
            order, sizes = _by_part(key[sent], parts)
            again = ~first
            again[sent] = _told(row["answer1"], "repeated", sizes, order)
            at = at[again]
            removed = chunk.covered(
                np.concatenate([chunk.start[repeated], at]), np.concatenate([chunk.end[repeated], at + window])
            )
            size = np.diff(chunk.words.first)
            yield pa.record_batch(
                {
                    "doc_id": row["doc_id"].values,
                    "n_words": pa.array(size, pa.int64()),
                    "n_removed": pa.array(np.bincount(chunk.doc[removed], minlength=len(size)), pa.int64()),
                    "kept": pa.array(chunk.words.joined(~removed), pa.binary()),
                }
            )

    return run


def _asked(rows: DataFrame, question: Callable, parts: int) -> DataFrame:
    """Answers of the owners of all parts to what the chunks ask, one row per chunk."""
    packed = rows.mapInArrow(question, _PACKED).repartition(parts, "part")
    given = F.collect_list(F.struct("part", "repeated", "shared")).alias("answers")
    return written(packed.mapInArrow(_owner, _ANSWER).groupBy("chunk").agg(given), "answers")


def without_repeats(docs: DataFrame, text: str = "text", *, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept``; ``kept`` is the words that stay, joined by a blank."""
    chunks = _Bucketed(docs, text)
    parts = chunks.parts
    symbols = _asked(chunks.rows, _symbol_rows(parts, window), parts)
    windows = _asked(chunks.with_answers(symbols), _window_rows(parts, window), parts)
    result = chunks.with_answers(symbols, windows).mapInArrow(
        _kept_rows(parts, window), "doc_id long, n_words long, n_removed long, kept binary"
    )
    return result.withColumn("kept", F.col("kept").cast("string"))


def repeat_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``."""
    return without_repeats(docs, text).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
