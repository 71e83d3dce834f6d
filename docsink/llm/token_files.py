"""Token-id files with bit-plane shuffling (operator 5).

Documents are dealt out by ranges of ``doc_id``, so shard after shard holds
them in ascending order; each task streams its shard into one file. Ids are
collected in blocks of ``BLOCK`` and transposed into planes: all first bytes,
all second bytes and so on (or all bits of one place), so that the nearly
constant high planes shrink to nothing; each plane is compressed by zstandard.

A file is, all little-endian::

    "PLN1"                                     4 bytes
    chunks                                     planes of block 0, planes of block 1, ...
    chunk index                                zstandard of: offset, first id, ids, sizes of planes, as u64 per chunk
    document index                             zstandard of: doc_id, ids, known (0 or 1), as i64 per document
    footer, 48 bytes                           offset and size of either index, planes, ids in all, as 6 x u64

so any range of ids is read by its chunks alone. A shard's file gets a name of
its own per task attempt, and only names in the index table count: an attempt
that was lost leaves nothing that is read. The folder is the shared one, by any
scheme that ``pyarrow.fs`` knows.

Ids come from the tokenizers library. Texts are cut, in numpy, where a
pre-token surely starts: before single spaces, around single line feeds and
before marks after letters. A piece is encoded once and remembered by two 64-bit
hashes in sorted arrays, from which the ids of whole texts are gathered; the
pieces not used for longest are forgotten. Texts with special strings, with white
space at an end of a piece, or with pieces that only the second hash tells apart
go through the library whole.

Defined results: null and empty texts are just the end id. Documents of equal
``doc_id`` follow in the order of a hash of their text; a null ``doc_id`` comes
first and is read back as null.
"""

from __future__ import annotations

import io
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docsink.llm.common import mix64, text_of, written
from docsink.llm.token_counts import byte_letters, default_vocabulary, read_vocabulary
from docsink.plans.tables import work_dir

MAGIC = b"PLN1"
BLOCK = 1 << 15
END_ID = 0
LEVEL = 3
MAX_REMEMBERED = 1_000_000  # pieces, by a Python worker
MAX_POOL = 8_000_000  # ids of all of them
LEARN_PIECES = 4000
BLOCK_PIECES = 500_000  # looked up together
LONG = 64  # bytes of a piece, beyond which it is hashed by itself
CHUNK_CHARS = 2_000_000

_PACK = struct.Struct("<6Q")
_KEPT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first bytes of a word


class IdEncoder:
    """The library's ids of whole texts, as little-endian bytes.

    Pieces that were met are remembered in sorted arrays: two hashes of a piece
    and where its ids lie in a pool. A piece without ids cannot be encoded apart.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = read_vocabulary(path)
        self.whole = Tokenizer.from_file(path)
        self.special = [t["content"] for t in spec["added_tokens"]]
        letter = {byte: letter for letter, byte in byte_letters().items()}
        vocabulary = spec["model"]["vocab"]
        self.begins = {}  # ids that begin with a space, with a line feed
        for byte in b" \n":
            self.begins[chr(byte)] = np.zeros(max(vocabulary.values()) + 1, bool)
            self.begins[chr(byte)][[i for entry, i in vocabulary.items() if entry.startswith(letter[byte])]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.at, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.pool, self.calls = np.zeros(0, "<u4"), 0

    def encode(self, texts: list[str]) -> list[bytes]:
        packed = [t.encode() for t in texts]
        data = b"".join(packed)
        ends = np.cumsum([len(p) for p in packed], dtype=np.int64)
        del packed
        starts = np.append(_cuts(data, ends), len(data))
        blocks = [(np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, bool))]
        for first in range(0, len(starts) - 1, BLOCK_PIECES):
            block = starts[first : first + BLOCK_PIECES + 1]
            blocks.append(self._encode_pieces(data[block[0] : block[-1]], block[:-1] - block[0]))
        found, sizes, whole = (np.concatenate(column) for column in zip(*blocks, strict=True))
        del blocks
        ids = found.tobytes()
        before = np.concatenate([[0], np.cumsum(sizes)])
        bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
        bad = np.concatenate([[0], np.cumsum(whole)])[bounds]
        out = []
        for text, a, b, is_whole in zip(
            texts, (4 * before[bounds[:-1]]).tolist(), (4 * before[bounds[1:]]).tolist(), (np.diff(bad) > 0).tolist(), strict=True
        ):
            if is_whole or any(s in text for s in self.special):
                out.append(_bytes(self.whole.encode(text, add_special_tokens=False).ids))
            else:
                out.append(ids[a:b])
        return out

    def _encode_pieces(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, how many each has, and which can only be encoded with the text around them."""
        keys, checks = _hashes(data, starts)
        order = np.argsort(keys)
        new = np.ones(len(order), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        place = self._places(data, starts, keys, checks, order[new])[which]
        sizes = self.sizes[place]
        skipped = self.at[place] - (np.cumsum(sizes) - sizes)
        ids = self.pool[np.repeat(skipped, sizes) + np.arange(sizes.sum())]
        # Pieces of one key are one piece, unless the second hash tells them apart.
        return ids, sizes, (sizes == 0) | (self.checks[place] != checks)

    def _places(self, data: bytes, starts: np.ndarray, keys: np.ndarray, checks: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Where the pieces ``first``, sorted by key, are remembered; those not met before are learnt."""
        self.calls += 1
        if len(self.keys) > MAX_REMEMBERED or len(self.pool) > MAX_POOL:
            self._keep(self.used > np.median(self.used))
        found = np.searchsorted(self.keys, keys[first])
        known = np.zeros(len(first), bool)
        inside = found < len(self.keys)
        known[inside] = self.keys[found[inside]] == keys[first[inside]]
        fresh, at = first[~known], found[~known]
        stops = np.append(starts[1:], len(data))
        pieces = [data[a:b].decode() for a, b in zip(starts[fresh].tolist(), stops[fresh].tolist(), strict=True)]
        pool, begins, sizes = self._learn(pieces)
        self.keys = np.insert(self.keys, at, keys[fresh])
        self.checks = np.insert(self.checks, at, checks[fresh])
        self.at = np.insert(self.at, at, len(self.pool) + begins)
        self.sizes = np.insert(self.sizes, at, sizes)
        self.used = np.insert(self.used, at, self.calls)
        self.pool = np.concatenate([self.pool, pool])
        places = found + np.cumsum(~known) - ~known
        self.used[places] = self.calls
        return places

    def _keep(self, kept: np.ndarray) -> None:
        """Forget all other pieces."""
        self.keys, self.checks, self.used = self.keys[kept], self.checks[kept], self.used[kept]
        at, self.sizes = self.at[kept], self.sizes[kept]
        self.at = np.cumsum(self.sizes) - self.sizes
        self.pool = self.pool[np.repeat(at - self.at, self.sizes) + np.arange(self.sizes.sum())]

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, and where they begin for each piece and how many they are.

        What is empty or has white space at an end, but for the one space
        before it, cannot be encoded apart and gets no ids; a line feed alone
        was cut out where it can be. Many pieces are encoded in one text, in
        which ids that begin with what stands between them tell where each begins.
        """
        at, sizes = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        spaced, bare, alone = [], [], []
        for i, piece in enumerate(pieces):
            if piece[0] == " ":
                if len(piece) > 1 and piece[1:].strip() == piece[1:]:
                    spaced.append(i)
            elif piece == "\n":
                alone.append([i])
            elif piece.strip() == piece:
                if "\n" in piece:
                    alone.append([i])
                else:
                    bare.append(i)
        parts, held = [np.zeros(0, "<u4")], 0
        for some in (*_slices(spaced), *_slices(bare), *alone):
            texts = [pieces[i] for i in some]
            mark = " " if texts[0][0] == " " else "\n"
            if len(some) == 1:
                found = self._ids(texts[0])
                begins, skipped = np.zeros(1, np.int64), 0
            else:
                found = self._ids("".join(texts) if mark == " " else "\n" + "\n".join(texts))
                begins, skipped = np.flatnonzero(self.begins[mark][found]), int(mark == "\n")
            if len(begins) != len(some):
                raise ValueError("pieces and their ids do not agree")
            at[some] = held + begins + skipped
            sizes[some] = np.diff(np.append(begins, len(found))) - skipped
            parts.append(found)
            held += len(found)
        return np.concatenate(parts), at, sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


def _slices(places: list[int]) -> list[list[int]]:
    return [places[start : start + LEARN_PIECES] for start in range(0, len(places), LEARN_PIECES)]


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _classes() -> np.ndarray:
    """Of every byte: 1 is an ASCII letter or digit, 2 another visible ASCII character, 0 anything else."""
    table = np.zeros(256, np.uint8)
    table[33:127] = 2
    for first, last in ("09", "AZ", "az"):
        table[ord(first) : ord(last) + 1] = 1
    return table


_CLASSES = _classes()
_MARKS = _CLASSES == 2
_MARKS[ord("'")] = False  # may begin a pre-token with the letters after it


def _cuts(data: bytes, ends: np.ndarray) -> np.ndarray:
    """Where the pieces of texts start: places at which a pre-token surely starts, if pieces have no white space at an end."""
    found = np.frombuffer(data, np.uint8)
    spaces = np.flatnonzero(found == 32)
    marks = np.flatnonzero(_MARKS[found])
    marks = marks[_is_letter(found, marks - 1)]
    lines = np.flatnonzero(found == 10)
    lines = lines[(lines > 0) & (lines < len(data) - 1)]
    # Between what surely is no white space, a line feed is a pre-token.
    lines = lines[(_CLASSES[found[lines - 1]] > 0) | _is_letter(found, lines - 1)]
    after = found[lines + 1]
    lines = lines[(_CLASSES[after] > 0) | ((after >= 0xC3) & (after <= 0xC9))]
    cut = np.zeros(len(data) + 1, bool)
    cut[0] = True
    for places in (spaces, marks, lines, lines + 1, ends):
        cut[places] = True
    cut[len(data)] = False
    return np.flatnonzero(cut[: len(data)])


def _is_letter(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an ASCII letter or digit, or a letter from U+00C0 to U+024F, ends at a place."""
    lead, last = found[np.maximum(at - 1, 0)], found[np.maximum(at, 0)]
    two = (lead >= 0xC3) & (lead <= 0xC9) & (last >= 0x80) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    return ((at >= 0) & (_CLASSES[last] == 1)) | ((at >= 1) & two)


def _hashes(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every piece."""
    words = np.frombuffer(data + bytes(24 - len(data) % 8), "<u8")
    sizes = np.diff(np.append(starts, len(data)))
    one = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    two = ~one
    at = np.flatnonzero(sizes <= LONG)
    place, left = starts[at], sizes[at]
    while len(at):
        word, shift = place >> 3, ((place & 7) << 3).astype(np.uint64)
        value = (words[word] >> shift) | ((words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        value &= _KEPT[np.minimum(left, 8)]
        mixed = (one[at] ^ value) * np.uint64(0xFF51AFD7ED558CCD)
        one[at] = mixed ^ (mixed >> np.uint64(32))
        mixed = (two[at] + value) * np.uint64(0xC4CEB9FE1A85EC53)
        two[at] = mixed ^ (mixed >> np.uint64(29))
        more = left > 8
        at, place, left = at[more], place[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > LONG).tolist():
        both = xxhash.xxh3_128_intdigest(data[starts[i] : starts[i] + sizes[i]])
        one[i], two[i] = both >> 64, both & 0xFFFFFFFFFFFFFFFF
    return mix64(one), two


@lru_cache(maxsize=1)
def _encoder(path: str) -> IdEncoder:
    return IdEncoder(path)


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of 32-bit ids."""
    table = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [table[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(table, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(32)]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == 4:
        table = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes], axis=1)
        table = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(table).view("<u4").ravel()


class ShardWriter:
    def __init__(self, sink: io.RawIOBase, planes: int = 4, block: int = BLOCK) -> None:
        self.sink, self.planes, self.block = sink, planes, block
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.offset, self.ids = len(MAGIC), 0
        self.waiting, self.held = [], 0
        self.chunks: list[list[int]] = []
        self.docs: list[np.ndarray] = []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(np.array([doc_id or 0, len(ids) // 4, doc_id is not None], "<i8"))
        self.waiting.append(ids)
        self.held += len(ids) // 4
        if self.held >= 16 * self.block:
            self._flush(self.held // self.block * self.block)

    def _flush(self, count: int) -> None:
        held = np.frombuffer(b"".join(self.waiting), "<u4")
        for start in range(0, count, self.block):
            part = held[start : min(start + self.block, count)]
            packed = [self.packer.compress(p) for p in to_planes(part, self.planes)]
            self.chunks.append([self.offset, self.ids, len(part), *map(len, packed)])
            self.sink.write(b"".join(packed))
            self.offset += sum(map(len, packed))
            self.ids += len(part)
        self.waiting, self.held = [held[count:].tobytes()], len(held) - count

    def close(self) -> None:
        self._flush(self.held)
        chunks = self.packer.compress(np.array(self.chunks, "<u8").tobytes())
        docs = self.packer.compress(np.concatenate([np.zeros(0, "<i8"), *self.docs]).tobytes())
        self.sink.write(chunks + docs)
        at = self.offset
        self.sink.write(_PACK.pack(at, len(chunks), at + len(chunks), len(docs), self.planes, self.ids))


class ShardReader:
    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        at_chunks, n_chunks, at_docs, n_docs, self.planes, self.ids = _PACK.unpack(self._at(source.size() - _PACK.size, _PACK.size))
        self.unpacker = zstandard.ZstdDecompressor()
        if self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a token-id file")
        self.chunks = np.frombuffer(self.unpacker.decompress(self._at(at_chunks, n_chunks)), "<u8").reshape(-1, 3 + self.planes)
        self.docs = np.frombuffer(self.unpacker.decompress(self._at(at_docs, n_docs)), "<i8").reshape(-1, 3)

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def chunk(self, number: int) -> np.ndarray:
        offset, _, count, *sizes = self.chunks[number].tolist()
        raw, planes = self._at(offset, sum(sizes)), []
        for size in sizes:
            planes.append(self.unpacker.decompress(raw[:size]))
            raw = raw[size:]
        return from_planes(planes, count)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` up to ``stop``, from their chunks alone."""
        firsts = self.chunks[:, 1].astype(np.int64)
        parts = []
        for number in range(int(np.searchsorted(firsts, start, "right")) - 1, len(firsts)):
            if firsts[number] >= stop:
                break
            ids = self.chunk(number)
            parts.append(ids[max(0, start - firsts[number]) : stop - firsts[number]])
        return np.concatenate([np.zeros(0, "<u4"), *parts])

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """``doc_id``, place of the first id, ids, CRC-32 of the ids, one document after another."""
        held, number, place = b"", 0, 0
        for doc_id, count, known in self.docs.tolist():
            crc, left = 0, 4 * count
            while left:
                if not held:
                    held = self.chunk(number).astype("<u4").tobytes()
                    number += 1
                crc = zlib.crc32(held[:left], crc)
                taken = min(left, len(held))
                held, left = held[taken:], left - taken
            yield (doc_id if known else None), place, count, crc
            place += count


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _write_shard(root: str, vocabulary: str, planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{root}/shard-{task.partitionId():06d}-{task.taskAttemptId()}.ids"
        files, path = _open(name)
        files.create_dir(os.path.dirname(path), recursive=True)
        end = np.array([END_ID], "<u4").tobytes()
        docs = 0
        with files.open_output_stream(path) as sink:
            writer = ShardWriter(sink, planes)
            for batch in batches:
                names, texts = batch.column(0).to_pylist(), batch.column(1)
                begin = 0
                sizes = np.cumsum(pa.compute.binary_length(texts).to_numpy())
                while begin < len(names):
                    before = sizes[begin - 1] if begin else 0
                    stop = max(begin + 1, int(np.searchsorted(sizes, before + CHUNK_CHARS, "right")))
                    for doc_id, ids in zip(names[begin:stop], _encoder(vocabulary).encode(texts[begin:stop].to_pylist()), strict=True):
                        writer.add(doc_id, ids + end)
                    docs += min(stop, len(names)) - begin
                    begin = stop
            writer.close()
        yield pa.record_batch({"shard": [task.partitionId()], "path": [name], "docs": [docs], "ids": [writer.ids]})

    return run


def write_token_files(docs: DataFrame, root: str, *, vocabulary: str | None = None, planes: int = 4) -> DataFrame:
    """Write all documents below ``root``; the index of the files: ``shard, path, docs, ids, first``."""
    if planes not in (4, 32):
        raise ValueError("planes must be 4 (bytes) or 32 (bits)")
    order = [F.asc_nulls_first("doc_id"), F.asc("_tie")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    shards = rows.select("doc_id", "text").mapInArrow(
        _write_shard(root, vocabulary or default_vocabulary(), planes), "shard long, path string, docs long, ids long"
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so one task may sum them up.
    return written(shards, "files").withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            files, path = _open(row["path"])
            with files.open_input_file(path) as source:
                held = []
                for doc_id, place, count, crc in ShardReader(source).documents():
                    held.append((doc_id, row["first"] + place, count, crc))
                    if len(held) == 20_000:
                        yield _table(held)
                        held = []
                yield _table(held)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.record_batch({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def read_token_files(index: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    files = index.count()
    rows = index.select("path", "first").repartition(max(1, files), "path")
    return rows.mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write all documents and read them back."""
    return read_token_files(write_token_files(docs, f"{work_dir(spark, 'ids')}/files"))
