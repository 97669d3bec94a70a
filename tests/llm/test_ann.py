import numpy as np
import pytest
from pyspark.sql import functions as F

from lithosense.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, rank int"


def exact(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        s = (x * x[q]).sum(axis=1)
        keep = np.flatnonzero(np.arange(len(ids)) != q)
        best = keep[np.lexsort((ids[keep], -s[keep]))[:k]]
        out[int(ids[q])] = [(int(ids[b]), float(s[b])) for b in best]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def test_recall_scores_and_ties(spark):
    r = np.random.default_rng(1)
    centres = r.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.6 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[3][1]) for i in range(400)]  # a large group of one vector
    out = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=10, block_rows=200, leaf_sample=24).collect()
    want = exact(rows, 10)
    got = {}
    for x in sorted(out, key=lambda x: x["rank"]):
        got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
    assert got.keys() == want.keys() and all(len(v) == 10 for v in got.values())
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    hot = got[2000]
    assert [i for i, _ in hot] == [i for i, _ in want[2000]]


def test_odd_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-1.0, -1.0]), (20, None), (None, [1.0, 1.0])]
    out = [tuple(r) for r in ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert out == [(0, 1, 1, 1.0), (0, 2, 9, -3.0)]


def test_empty_table_and_single_vector(spark):
    assert ann.search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_walk_goes_on_until_k_candidates_are_held(spark):
    r = np.random.default_rng(6)
    centres = 10 * r.normal(size=(40, 8))
    rows = [(i, (centres[i % 40] + 0.1 * r.normal(size=8)).astype(np.float32).tolist()) for i in range(400)]
    # so little recall asks for one leaf, which holds fewer than k vectors
    out = ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=30, leaf_sample=12, recall=0.01)
    counts = {x["query_id"]: (x["n"], x["last"]) for x in out.groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()}
    assert counts == {q: (30, 30) for q in range(0, 400, 20)}
    few = ann.search(frame(spark, rows[:25]), F.col("vec_id") % 20 == 0, k=30, leaf_sample=4, recall=0.01)
    assert {x["query_id"]: x["count"] for x in few.groupBy("query_id").count().collect()} == {0: 24, 20: 24}


def test_leaves_come_out_best_bin_first():
    r = np.random.default_rng(4)
    points = r.normal(size=(600, 5))
    tree = ann.Tree(points, branches=4, leaf_sample=20)
    order = tree.visit(points[:5], tree.leaves)
    assert all(sorted(o) == list(range(tree.leaves)) for o in order)
    assert tree.place(points).max() < tree.leaves
    first, parts = ann._pack(4, {0: 5, 1: 25, 2: 3, 3: 4}, 10)
    assert parts == [1, 3, 1, 1] and first == [0, 1, 4, 4]
