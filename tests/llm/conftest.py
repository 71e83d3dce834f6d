import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from ``(doc_id, text)`` pairs."""

    def make(rows, **more):
        extra = "".join(f", {name} string" for name in more)
        data = [(i, t, "en", "s", None if t is None else len(t), *more.values()) for i, t in rows]
        return spark.createDataFrame(data, SCHEMA + extra)

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.randrange(50)}" for _ in range(n))
