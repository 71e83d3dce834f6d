import hashlib

import pytest
from pyspark.sql import functions as F

from docsink.llm.chat import CONTROL, conversation_digests, escaped, format_windows, read_windows, unescaped
from tests.llm.conftest import prose

SCHEMA = "conv_id long, turn long, role string, text string"


def talk(conv, turns, words, system=True):
    roles = ["system"] if system else []
    roles += [("user", "assistant")[i % 2] for i in range(turns)]
    return [(conv, i, role, prose(conv * 100 + i, words)) for i, role in enumerate(roles)]


@pytest.fixture
def turns(spark):
    rows = talk(1, 40, 40) + talk(2, 7, 5, False) + talk(3, 12, 300) + talk(4, 1, 3) + talk(5, 3000, 6)
    rows += [(6, None, None, None), (6, 1, "assistant", ""), (6, 1, "assistant", ""), (6, -2000, "user", "a\nb")]
    rows += [(7, i, "assistant" if i % 2 else "us|>er\\", f"{c} \\ {c[0]}\\{c[1:]} <|end|>\n<|+user|>\n") for i, c in enumerate(CONTROL)]
    rows += [(8, 0, "user", "hi"), (8, 1, "system", "late"), (8, 2, "assistant", prose(8, 3000)), (8, 3, "system", "second")]
    rows += [(None, 0, "user", "who"), (None, 1, "assistant", "nobody")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(r, r[2] or "", r[3] or "") for r in rows if r[0] == conv]
        mine.sort(key=lambda x: (x[0][1] is not None, x[0][1] or 0, x[1], x[2]))
        said = "".join(f"{role}\n{text}\n" for _, role, text in mine)
        learnt = "".join(text for _, role, text in mine if role == "assistant")
        out[conv] = (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(1024, 128), (200, 40), (64, 0)])
def test_windows_read_back(turns, budget, history):
    rows, frame = turns
    got = conversation_digests(format_windows(frame, budget=budget, history=history)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == expected(rows)


def test_windows_keep_the_budget_and_their_context(turns):
    rows, frame = turns
    windows = format_windows(frame, budget=200, history=40).orderBy("conv_id", "span").collect()
    tokens = {(r[0], r[1]): len((r[3] or "").split()) + 4 for r in rows}
    for conv in (1, 5):
        mine = [w for w in windows if w.conv_id == conv]
        assert len(mine) > 10
        for before, window in zip([None, *mine], mine):
            assert window.tokens <= 200
            pieces = window.text.split("<|end|>\n")
            assert ("<|+system|>" in pieces[0]) == (before is None) and ("<|=system|>" in pieces[0]) == (before is not None)
            repeated = [p for p in pieces[1:] if p.startswith("<|=")]
            if before is not None and conv == 5:
                assert repeated
    assert all(w.tokens > 200 for w in windows if w.conv_id == 8 and prose(8, 3000) in w.text)
    assert len(tokens) > 3000


def test_repeated_targets_are_masked(turns):
    _, frame = turns
    read = read_windows(format_windows(frame, budget=200, history=40)).where("conv_id = 5").orderBy("span").collect()
    learnt = [t for w in read for t in w.targets]
    assert len(learnt) == 1500 == len(set(learnt))
    shown = sum(w.text.count("assistant|>") for w in read)
    assert shown > 1500


def test_escaping_is_exact(spark):
    texts = [*CONTROL, "\\", "\\\\", "<\\|", "<\\\\|", "<|>", "<<|", "x<", "|", "\\n\n", "</s>[INST] ok [/INST]", "<<</SYS>>>"]
    texts += [a + b for a in CONTROL for b in CONTROL]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert row.u == row.t
        assert not any(c in row.e for c in CONTROL)


def test_no_python_on_the_main_path(turns, capsys):
    conversation_digests(format_windows(turns[1])).explain()
    assert "Python" not in capsys.readouterr().out.replace("ExistingRDD", "")


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", "x", "y")], SCHEMA + ", span string")
    assert conversation_digests(format_windows(frame.where("false"))).collect() == []
    assert conversation_digests(format_windows(frame)).first().loss_chars == 1
