import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lithosense.llm import hmm
from tests.llm.conftest import prose


@pytest.fixture
def small():
    r = np.random.default_rng(1)
    start, move, emit = r.random(3), r.random((3, 3)), r.random((3, 5))
    return start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)


def paths(seq, start, move, emit):
    """Every state path with its probability."""
    for path in itertools.product(range(len(start)), repeat=len(seq)):
        p = start[path[0]] * emit[path[0], seq[0]]
        for a, b, c in zip(path, path[1:], seq[1:]):
            p *= move[a, b] * emit[b, c]
        yield path, p


def test_forward_equals_the_sum_over_paths(small):
    seqs = [[0], [1, 2, 3], [4, 4, 0, 1, 2, 3, 0], [2, 2]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    got = hmm.log_forward(np.array(sum(seqs, [])), first, *small)
    assert got == pytest.approx([math.log10(sum(p for _, p in paths(s, *small))) for s in seqs])


def test_expected_counts_equal_the_sum_over_paths(small):
    start, move, emit = small
    seqs = [[0], [1, 2, 3], [4, 4, 0, 1]]
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    got = hmm.expected_counts(np.array(sum(seqs, [])), first, np.ones(3, bool), start, start, move, emit)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    for s in seqs:
        every = list(paths(s, *small))
        total = sum(p for _, p in every)
        for path, p in every:
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want[1][a, b] += p / total
            for a, c in zip(path, s):
                want[2][a, c] += p / total
    for a, b in zip(got, want):
        assert a == pytest.approx(b)


def test_every_sweep_raises_the_likelihood(small):
    start, move, emit = small
    r = np.random.default_rng(2)
    classes, first = r.integers(0, 5, 400), np.arange(0, 401, 20)
    last = -math.inf
    for _ in range(6):
        now = hmm.log_forward(classes, first, start, move, emit).sum()
        assert now >= last - 1e-9
        last = now
        s, m, e = hmm.expected_counts(classes, first, np.ones(20, bool), start, start, move, emit)
        start, move, emit = s / s.sum(), m / m.sum(1, keepdims=True), e / e.sum(1, keepdims=True)


def test_scores(spark, docs):
    two = ("der die und ist ein von zu".split(), "the of and to in is was".split())
    rows = [(i, " ".join([two[i % 2][k % 7] if k % 3 else prose(i * 50 + k, 1) for k in range(50)])) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "The ÀB\tthe " * 3000), (None, "of the"), (0, rows[0][1])]
    df = docs(rows).withColumnRenamed("lang", "score")
    out = hmm.score(df, states=3, sweeps=4).collect()
    assert len(out) == len(rows)

    def tokens(t):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2

    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = {i: (held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n) for i, t in rows}
    base = {i: sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t)) for i, t in rows}
    for r in out:
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]]
        assert r["base_score"] == pytest.approx(base[r["doc_id"]])
        assert r["score"] < 0 and math.isfinite(r["score"])
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_nothing_to_learn_from(spark, docs):
    from pyspark.sql import functions as F

    assert hmm.score(docs([])).count() == 0
    only = hmm.score(docs([(1, "a b")]), held_out=F.lit(True)).collect()[0]
    assert (only["n_known"], only["train_tokens"], only["base_score"]) == (0, 0, 0.0) and math.isfinite(only["score"])
