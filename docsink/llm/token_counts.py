"""Token counts with a whole-token shortcut (operator 4).

A byte-level BPE cuts a text into pre-tokens and merges each of them on its
own. Which vocabulary strings encode alone as one token is proved once, before
any text is read, by encoding every vocabulary string with the tokenizer's own
model (merges can miss an entry). In a text, pre-tokens among them count one
each; only the others are merged by the library, and remembered.

Special strings inside a text count as the library counts them by default: they
are cut out first and are one token each. Counts equal those of
``Tokenizer.encode(text, add_special_tokens=False)``.

Defined results: null and empty texts have no tokens and no bytes. The vocabulary
file is a parameter and is read where the tasks run; a vocabulary of another
kind than byte-level BPE without normaliser is refused.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docsink.llm.common import text_of

LIMIT = 1024
MAX_REMEMBERED = 400_000
LONG = 64  # pre-tokens longer than this are merged and forgotten

# How byte-level BPE cuts a text, white space as Unicode defines it.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    plain = spec["normalizer"] is None and spec["model"]["type"] == "BPE"
    cut = spec["pre_tokenizer"] or {}
    if not plain or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError(f"{path} is not a plain byte-level BPE")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError(f"{path} has added tokens that are not plain strings")
    return spec


def merger(spec: dict[str, Any]) -> Tokenizer:
    """The model alone: a string is one pre-token and holds no special string."""
    spec = {**spec, "added_tokens": [], "pre_tokenizer": {**spec["pre_tokenizer"], "use_regex": False}}
    return Tokenizer.from_str(json.dumps(spec))


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that the model encodes as exactly one token."""
    spec = read_vocabulary(path)
    letters = byte_letters()
    texts = []
    for entry in spec["model"]["vocab"]:
        try:
            texts.append(bytes(letters[c] for c in entry).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue
    encoded = merger(spec).encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, encoded, strict=True) if len(e) == 1]


class _Counts(dict):
    """Tokens of a pre-token: the proved ones from the start, others merged when first met."""

    def __init__(self, whole: list[str], model: Tokenizer) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.limit = len(self) + MAX_REMEMBERED
        self.whole, self.model = whole, model

    def __missing__(self, piece: str) -> int:
        count = len(self.model.encode(piece, add_special_tokens=False))
        if len(piece) <= LONG:
            if len(self) >= self.limit:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = count
        return count


class TokenCounter:
    def __init__(self, path: str, whole: list[str]) -> None:
        spec = read_vocabulary(path)
        self.counts = _Counts(whole, merger(spec))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(PRE_TOKEN).findall

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return sum(map(self.counts.__getitem__, self.pieces(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.pieces(p))) for p in parts)


@lru_cache(maxsize=2)
def _counter(path: str, whole: tuple[str, ...]) -> TokenCounter:
    return TokenCounter(path, list(whole))


def token_count(text: str = "text", vocabulary: str | None = None) -> Column:
    """Number of tokens of a text column."""
    path = vocabulary or default_vocabulary()
    whole = tuple(whole_tokens(path))

    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = _counter(path, whole).count
        for texts in batches:
            yield pd.Series([count(t) for t in texts], dtype="int64")

    counts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(counts, "long")(text_of(text))


def token_counts(docs: DataFrame, *, limit: int = LIMIT, vocabulary: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``."""
    counted = docs.select(
        "doc_id",
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        token_count(vocabulary=vocabulary).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
