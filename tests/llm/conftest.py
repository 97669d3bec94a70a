import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Builds a documents table from (doc_id, text) pairs."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t in rows], DOCS)

    return make


def prose(seed, n, words="the of and tion ment ing ado eau heit ung was from with that this here there over under".split()):
    """``n`` words of invented prose."""
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice(words) for _ in range(r.randint(1, 3))) for _ in range(n))
