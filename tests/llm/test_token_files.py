import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import BufferReader
from tokenizers import Tokenizer

from docsink.llm import token_files
from docsink.llm.token_counts import default_vocabulary
from docsink.llm.token_files import IdEncoder, ShardReader, ShardWriter, from_planes, read_token_files, to_planes, write_token_files
from tests.llm.conftest import prose
from tests.llm.test_token_counts import LIBRARY, ODD

PATH = default_vocabulary()
ENCODER = IdEncoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sd.,aZ0é<|endoftext|>"), st.characters(exclude_categories=["Cs"]))), max_size=6))
def test_ids_are_the_librarys(texts):
    for text, ids in zip(texts, ENCODER.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


class _Counting:
    """A tokenizer that counts the characters it is given."""

    def __init__(self, whole):
        self.whole, self.chars = whole, 0

    def encode(self, text, **options):
        self.chars += len(text)
        return self.whole.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.whole.encode_batch_fast(texts, **options)


def test_a_word_is_encoded_once_whatever_stands_beside_it():
    encoder, words = IdEncoder(PATH), sorted(set(prose(5, 4000).split()))
    encoder.whole = _Counting(encoder.whole)
    marks = ("", ",", ".", "%%%", "$$$", "&&&", "***", "###")
    texts = [f"é {w}{mark}\né\né {w}{mark}" for w in words for mark in marks]
    got = encoder.encode(texts)
    assert encoder.whole.chars < 3 * sum(map(len, words))
    for text, ids in zip(texts[::37], got[::37], strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    before = encoder.whole.chars
    assert encoder.encode(texts) == got and encoder.whole.chars == before


@pytest.mark.parametrize("limits", [{"MAX_REMEMBERED": 40}, {"MAX_POOL": 100}, {"LONG": 3}, {"LEARN_PIECES": 1}, {"BLOCK_PIECES": 7}])
def test_forgetting_and_long_pieces(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(token_files, name, value)
    encoder = IdEncoder(PATH)
    for first in (0, 3, 0, 7, 3):
        texts = [*(prose(first + i, 60) for i in range(4)), *ODD, "", "x" * 500, f"a\n{first}\nb"]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_pieces_of_equal_hash_are_told_apart(monkeypatch):
    hashes = token_files._hashes

    def poor(data, starts):
        one, two = hashes(data, starts)
        return one % np.uint64(16), two

    monkeypatch.setattr(token_files, "_hashes", poor)
    encoder = IdEncoder(PATH)
    for _ in range(2):
        texts = [*(prose(i, 3) for i in range(30)), *ODD]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("planes", [4, 32])
@pytest.mark.parametrize("count", [1, 7, 8, 1000])
def test_planes_round_trip(planes, count):
    ids = np.random.default_rng(count).integers(0, 2**32, count, dtype=np.uint64).astype("<u4")
    assert (from_planes(to_planes(ids, planes), count) == ids).all()


@pytest.mark.parametrize("planes", [4, 32])
def test_ranges_of_a_file(planes):
    sink, rng = io.BytesIO(), np.random.default_rng(0)
    docs = [rng.integers(0, 50_257, n).astype("<u4") for n in (5, 0, 1000, 3, 777)]
    writer = ShardWriter(sink, planes, block=64)
    for i, ids in enumerate(docs):
        writer.add(i or None, ids.tobytes())
    writer.close()
    reader = ShardReader(BufferReader(sink.getvalue()))
    everything = np.concatenate(docs)
    for start, stop in ((0, 1785), (0, 1), (63, 65), (64, 128), (1000, 1785), (500, 500)):
        assert (reader.read(start, stop) == everything[start:stop]).all()
    assert [(d, n, c) for d, _, n, c in reader.documents()] == [
        (i or None, len(ids), zlib.crc32(ids.tobytes())) for i, ids in enumerate(docs)
    ]


@pytest.mark.parametrize("planes", [4, 32])
def test_documents_are_read_back(documents, tmp_path, planes):
    rows = [(i * 37 % 101, prose(i, 20)) for i in range(101)] + [(200 + i, t) for i, t in enumerate(ODD)]
    rows += [(300, None), (None, "first of all"), (400, "long words " * 20_000)]
    index = write_token_files(documents(rows, start="x"), f"{tmp_path}/ids", planes=planes)
    got = {r.doc_id: tuple(r)[1:] for r in read_token_files(index).collect()}
    start, library = 0, Tokenizer.from_file(PATH)
    for i, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert got.pop(i) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_repeated_ids_are_kept(documents, tmp_path):
    index = write_token_files(documents([(1, "a"), (1, "b b"), (1, "b b"), (0, "c")]), f"{tmp_path}/ids")
    got = sorted(map(tuple, read_token_files(index).collect()))
    assert [g[0] for g in got] == [0, 1, 1, 1]
    assert [g[1] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()]


def test_empty_table(documents, tmp_path):
    assert read_token_files(write_token_files(documents([]), f"{tmp_path}/ids")).collect() == []
