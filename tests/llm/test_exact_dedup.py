import hashlib
from collections import defaultdict

import pytest

from docsink.llm.exact_dedup import exact_dedup, exact_dedup_report
from tests.llm.conftest import prose

ROWS = [(i, prose(i % 40, 30)) for i in range(200)] + [(500, None), (501, ""), (502, " "), (503, "A"), (504, "a")]
ROWS += [(600, prose(1, 30)), (600, prose(1, 30)), (None, "only here"), (None, "A"), (700, "long " * 60_000)]


def expected(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        digest, left = hashlib.sha256(text.encode()).hexdigest(), True
        for i in ids:
            out.append((i, best, len(ids), i == best and left, digest))
            left = left and i != best
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_filter_bytes", [1 << 20, 128])
def test_report_equals_brute_force(documents, max_filter_bytes):
    """Also where the filter is so small that unique rows look repeated."""
    got = exact_dedup_report(documents(ROWS), max_filter_bytes=max_filter_bytes).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)


def test_keeps_whole_rows_with_clashing_columns(documents):
    docs = documents(ROWS, kept="x", _sha="y", _row="z")
    got = exact_dedup(docs)
    assert got.columns == docs.columns
    want = [(i, best) for i, best, _, kept, _ in expected(ROWS) if kept]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((i for i, _ in want), key=repr)
    assert {r.kept for r in got.collect()} == {"x"}


def test_empty_table(documents):
    assert exact_dedup_report(documents([])).collect() == []
    assert exact_dedup(documents([])).collect() == []


def test_one_group_holds_most_rows(documents):
    rows = [(i, "same") for i in range(3000)] + [(5000 + i, f"other {i}") for i in range(50)]
    got = {r.doc_id: r for r in exact_dedup_report(documents(rows)).collect()}
    assert len(got) == 3050
    assert {(r.keep_id, r.group_size) for i, r in got.items() if i < 3000} == {(2999, 3000)}
    assert exact_dedup(documents(rows)).count() == 51
