"""Queries against SQL, and against the operators' brute-force checks on the given tables."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from docsink.llm.queries import ORACLES, QUERIES
from docsink.llm.token_counts import default_vocabulary
from tests.test_oracle import SF_DIR, _canonical, duck  # noqa: F401

LIBRARY = Tokenizer.from_file(default_vocabulary())


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):  # noqa: F811
    df = QUERIES[name](spark, SF_DIR)
    got = _canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want = _canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want and got[1]


def test_tokens_are_the_librarys(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counts = {r.doc_id: r for r in QUERIES["op4_token_counts"](spark, SF_DIR).collect()}
    files = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, SF_DIR).collect()}
    assert set(counts) == set(files) == set(docs)
    start = 0
    for i in sorted(docs):
        ids = LIBRARY.encode(docs[i], add_special_tokens=False).ids
        assert counts[i].n_tokens == len(ids) and counts[i].n_bytes == len(docs[i].encode())
        raw = np.array([*ids, 0], "<u4").tobytes()
        assert tuple(files[i])[1:] == (start, len(ids) + 1, zlib.crc32(raw))
        start += len(ids) + 1


def test_pipeline_stages_filter_as_the_operators_say(spark, documents):
    """Each stage works on all that its predecessor kept; the last rows are those that all stages keep."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    left, columns = docs, docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, left, SF_DIR)
        assert kept.columns == columns
        rows = kept.collect()
        assert 0 < len(rows) < left.count()
        left = spark.createDataFrame(rows, docs.schema)
    assert sorted(r.doc_id for r in packed) == sorted(r.doc_id for r in left.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "near duplicates", "decontamination", "packing"
    ]
