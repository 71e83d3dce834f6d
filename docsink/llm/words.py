"""Words of many texts at once, as byte ranges and 64-bit numbers.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form
feed and carriage return. Equal words have equal numbers in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from docsink.llm.common import mix64

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)


@dataclass
class Words:
    """Words of ``n`` texts in order; ``doc`` is the number of a word's text."""

    n: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Number of the first word of each text, and the number of all words."""
        return np.searchsorted(self.doc, np.arange(self.n + 1))

    def numbers(self) -> np.ndarray:
        """A 64-bit number per word, made from its bytes eight at a time."""
        length = self.end - self.start
        order = np.argsort(-length, kind="stable")
        start, left = self.start[order], length[order]
        loads = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        hashed = mix64(left.astype(np.uint64))
        at, busy = 0, len(order)
        while busy:
            part = loads[start[:busy] + at] & _MASKS[np.minimum(left[:busy] - at, 8)]
            hashed[:busy] = mix64(hashed[:busy] ^ part)
            at += 8
            busy = int(np.searchsorted(-left[:busy], -at, side="left"))
        result = np.empty(len(order), np.uint64)
        result[order] = hashed
        return result

    def heads(self) -> np.ndarray:
        """The first eight bytes of each word, with what follows it where it is shorter."""
        return np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))[self.start]

    def joined(self, kept: np.ndarray) -> list[bytes]:
        """Of each text the words marked ``kept``, joined by one blank."""
        # Every word is followed by white space, which becomes the blank.
        change = np.zeros(len(self.data) + 1, np.int8)
        change[self.start[kept]] = 1
        change[self.end[kept] + 1] -= 1
        mask = np.cumsum(change[:-1], dtype=np.int8).view(bool)
        data = self.data.copy()
        data[self.end] = 0x20
        out = data[mask].tobytes()
        size = np.bincount(self.doc[kept], (self.end - self.start + 1)[kept], self.n).astype(np.int64)
        stop = np.cumsum(size)
        return [out[a : max(a, b - 1)] for a, b in zip((stop - size).tolist(), stop.tolist(), strict=True)]


def split_words(texts: list[bytes], letters: np.ndarray | None = None) -> Words:
    """Words of texts; ``letters``, a table by byte, says what they are made of if not of all but white space."""
    # Eight more bytes, so that a word can be read eight bytes at a time.
    data = np.frombuffer(b" ".join([*texts, b" " * 8]), np.uint8)
    inside = np.concatenate([[False], (~_SPACE if letters is None else letters)[data]])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turn[0::2], turn[1::2]
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return Words(len(texts), data, start, end, np.searchsorted(begin, start, side="right") - 1)


def pieces(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """A batch in slices of about ``size`` bytes of text, one row at least."""
    texts = [t or b"" for t in batch.column(column).to_pylist()]
    begin = 0
    while begin < len(texts):
        end, total = begin, 0
        while end < len(texts) and (end == begin or total + len(texts[end]) <= size):
            total += len(texts[end])
            end += 1
        yield batch.slice(begin, end - begin), texts[begin:end]
        begin = end
