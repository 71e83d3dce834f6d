import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docsink.llm import lm_scoring
from docsink.llm.lm_scoring import lm_scores, sample_tables, stirling
from tests.llm.conftest import prose


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


ROWS = [(i, prose(i % 50, 60)) for i in range(300)]
ROWS += [(400, None), (401, ""), (402, "Ünïcode ÀB　x\u2028y\x1cz Q"), (None, "no id here"), (403, "a"), (403, "a"), (403, "b b")]
ROWS += [(404, prose(3, 60_000)), (405, "never seen words at all: zzz yyy xxx"), (406, "\t\n\x0b\x0c\r ")]


@pytest.fixture(scope="module")
def small():
    """More rare words than frequent ones, also on small tables."""
    before = lm_scoring.HOT_WORDS
    lm_scoring.HOT_WORDS = 40
    yield
    lm_scoring.HOT_WORDS = before


def test_counts_and_base_scores(documents, small):
    got = lm_scores(documents(ROWS, score="x", row="y")).collect()
    train = Counter()
    for i, text in ROWS:
        if not is_held_out(i):
            train.update(tokens(text))
    total, kinds = sum(train.values()), len(train)
    want = Counter()
    for i, text in ROWS:
        words = tokens(text)
        base = sum(math.log10((train[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        want[i, is_held_out(i), len(words), sum(train[w] > 0 for w in words), total, round(base, 4)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_probabilities_sum_to_one(documents, small):
    """Over all known words and the unknown one, in every restaurant."""
    docs = documents([(i, prose(i, 40)) for i in range(60)])
    model, seated = seat(docs)
    sums = np.zeros(len(model.parent))
    for part in seated:
        for word in range(len(part.names)):
            if part.root_customers()[word]:
                sums += lm_scoring._everywhere(part, word)
    total, unknown = model.root()
    below = model.customers()
    classes = slice(0, lm_scoring.CLASSES + 1)
    s1, d1, s2, d2 = model.strengths[1], model.discounts[1], model.strengths[2], model.discounts[2]
    rest = (s1 + d1 * model.tables[classes]) / (s1 + below[classes]) * unknown
    deep = slice(lm_scoring.CLASSES + 1, None)
    rest = np.append(rest, (s2 + d2 * model.tables[deep]) / (s2 + below[deep]) * rest[model.parent[deep]])
    assert np.allclose(sums + rest, 1.0, atol=1e-9)


def seat(docs):
    """All parts with everybody of a word at one table, and the totals that go with it."""
    model, packed, _, parts = lm_scoring.train_model(docs)
    pieces = packed.where("kind in (0, 3)")
    cells = pieces.mapInArrow(lm_scoring._cells_of_pieces, "part long, a binary, b binary, c binary").repartition(parts, "part")
    rows = cells.mapInArrow(lm_scoring._merged, "part long, a binary, b binary, c binary").collect()
    seated = [lm_scoring.Part(r.asDict(), model) for r in rows]
    model.take(np.sum([p.sums(False) for p in seated], axis=0))
    return model, seated


def test_stirling_numbers():
    table = np.exp(stirling(6, 0.0))
    assert table[4, 1:5].round(6).tolist() == [6, 11, 6, 1]
    # Rising factorials: the weights of all seatings of c customers.
    d, s, c = 0.3, 1.7, 6
    whole = sum(np.exp(stirling(c, d)[c, t]) * np.prod([s + d * j for j in range(t)]) for t in range(1, c + 1))
    assert math.isclose(whole, np.prod([s + i for i in range(c)]), rel_tol=1e-9)


def test_sampled_tables_follow_the_conditional():
    rng, d, c, n = np.random.default_rng(0), 0.4, 5, 40_000
    base, mass = np.full(n, 0.2), np.full(n, 3.0)
    got = np.bincount(sample_tables(np.full(n, c), base, mass, d, rng, stirling(40, d)), minlength=c + 1)[1:] / n
    weight = np.array([np.exp(stirling(c, d)[c, t]) * 0.2**t * np.prod([3 + d * j for j in range(t)]) for t in range(1, c + 1)])
    assert np.abs(got - weight / weight.sum()).max() < 0.01
    many = sample_tables(np.array([0, 1, 10_000, 10**9]), np.full(4, 0.1), np.full(4, 50.0), d, rng, stirling(40, d))
    assert many[:2].tolist() == [0, 1] and 1 < many[2] < many[3] < 10**9


def test_small_tables(documents):
    assert lm_scores(documents([])).collect() == []
    held = next(i for i in range(100) if is_held_out(i))
    (only,) = lm_scores(documents([(held, "nothing to learn from")])).collect()
    assert only.train_tokens == 0 and only.n_known == 0 and only.n_tokens == 5
    (one,) = lm_scores(documents([(held + 1 if not is_held_out(held + 1) else held + 2, None)])).collect()
    assert one.n_tokens == one.n_known == 1


def test_every_word_is_a_context(documents, small):
    """Words that are not among the most frequent, of one class: each has learnt what follows it."""
    lm_scoring.HOT_WORDS = 3
    train, held = [i for i in range(400) if not is_held_out(i)], [i for i in range(400) if is_held_out(i)]
    rows = [(i, f"{'xx' if i % 2 else 'yy'}-ing {'left' if i % 2 else 'right'} " + "of the way " * 5) for i in train]
    rows += [(held[0], "xx-ing left"), (held[1], "xx-ing right"), (held[2], "yy-ing left"), (held[3], "yy-ing right")]
    # The words before and after are rare, or the word after is frequent and follows one of the two alone.
    rows += [(i + 1000, f"{'xx' if i % 2 else 'yy'}-est {'the' if i % 2 else 'unit'}") for i in range(300)]
    held = [*held[:4], *[i for i in range(2000, 2100) if is_held_out(i)][:2]]
    rows += [(held[4], "xx-est the"), (held[5], "yy-est the")]
    got = {r.doc_id: r.score for r in lm_scores(documents(rows)).collect()}
    right, wrong, other, same, frequent, never = [got[i] for i in held]
    assert right > wrong + 1 and same > other + 1 and frequent > never + 1


def test_rare_restaurants_are_whole(documents, small):
    """Customers and tables that lie in several parts sum up to the totals that all parts use."""
    model, _, (cells, after, seats, _), parts = lm_scoring.train_model(documents(ROWS))
    replies = {}
    for r in seats.where("kind in (0, 1)").collect():
        replies[r.kind, r.part, r.stretch] = r.asDict()
    own, rest, total, spread, discount = Counter(), {}, {}, Counter(), model.discounts[3]
    for row in cells.where(f"part < {parts}").collect():
        part = lm_scoring.Part(row.asDict(), model)
        part.take_seats({g: v for (k, p, g), v in replies.items() if k == 0 and p == row.part}, parts)
        count = part.count[part.rare]
        assert ((part.rare_tables >= np.minimum(count, 1)) & (part.rare_tables <= count)).all()
        for u, c, t, a, b in zip(part.before, count, part.rare_tables, part.rare_rest, part.rare_total, strict=True):
            own[u] += c - discount * t
            assert rest.setdefault(u, a) == a and total.setdefault(u, b) == b
        spread.update(set(part.before.tolist()))
    for row in after.collect():
        words = lm_scoring._words_of(row.a)
        tables, left, whole = lm_scoring._reply(replies[1, row.part, row.part], words, model)
        for u, c, t, a, b in zip(words, lm_scoring._unpack(row.c, "<u4"), tables, left, whole, strict=True):
            own[u] += int(c) - discount * t
            assert rest.setdefault(u, a) == a and total.setdefault(u, b) == b
    train = {w for i, text in ROWS if not is_held_out(i) for w in tokens(text)}
    assert len(own) > len(train) - 50 and max(spread.values()) > 1
    assert all(math.isclose(own[u] + rest[u], total[u], rel_tol=1e-9) for u in own)


def test_whole_restaurants_follow_their_joint_distribution():
    """Two words in one restaurant, against all seatings; the strength is the one of the highest likelihood."""
    rng, d, n = np.random.default_rng(1), 0.4, 20_000
    counts, base = np.tile([4, 3, 1], n), np.tile([0.3, 0.2, 0.1], n)
    of = np.repeat(np.arange(n), 3)
    tables, s = lm_scoring.seat_restaurants(of, counts, base, d, rng, stirling(40, d))
    assert s in lm_scoring.RARE_STRENGTHS
    table = np.exp(stirling(6, d))
    weight = np.array(
        [
            [table[4, t] * 0.3**t * table[3, u] * 0.2**u * np.prod([s + d * j for j in range(t + u + 1)]) for u in (1, 2, 3)]
            for t in (1, 2, 3, 4)
        ]
    )
    tables = tables.reshape(n, 3)
    got = np.zeros((4, 3))
    np.add.at(got, (tables[:, 0] - 1, tables[:, 1] - 1), 1 / n)
    assert (tables[:, 2] == 1).all()
    assert np.abs(got - weight / weight.sum()).max() < 0.04


def test_tokens_are_numbered_together(monkeypatch):
    """Short words take no call each, and are numbered as a plain loop would number them."""
    asked = []

    class Asked:
        @staticmethod
        def xxh64_intdigest(word):
            asked.append(word)
            return zlib.crc32(word)

    monkeypatch.setattr(lm_scoring, "xxhash", Asked)
    monkeypatch.setattr(lm_scoring, "SLICE_BYTES", 3000, raising=False)
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 70, raising=False)
    long = "Lang" * 50
    texts = [prose(i, 40) for i in range(60)] + ["", " ", "A\x0bb\ta\n", "x", f"{long} É é\xa0z {long.lower()}q {long}", "", "ﬀ\x1cß 😀"] + ["ends Here\r"]
    tokens, sizes = lm_scoring._tokens(texts)
    assert len(asked) <= 3 and all(len(word) >= 200 for word in asked)
    want = [[*re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower()), b" "] for t in texts]
    assert sizes.tolist() == [len(words) for words in want]
    flat = [w for words in want for w in words]
    assert lm_scoring._class_of(tokens).tolist() == [zlib.crc32(w[-2:]) % lm_scoring.CLASSES for w in flat]
    assert len(set(zip(flat, tokens.tolist(), strict=True))) == len(set(flat)) == len(set(tokens.tolist()))
    assert set(tokens[np.cumsum(sizes) - 1].tolist()) == {int(lm_scoring._END)}
    assert all(len(x) == 0 for x in lm_scoring._tokens([]))
