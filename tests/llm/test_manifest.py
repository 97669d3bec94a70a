import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lithosense.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels_of(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def plain(rows, fanout):
    """doc_id -> list of (leaf, subroot, root, proof digest, runs) per row, in order."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels_of([leaf(r) for r in by[s]], fanout)
    top = levels_of([trees[s][-1][0] for s in names], fanout)

    def path(tree, i):
        for nodes in tree[:-1]:
            start = i - i % fanout
            yield i % fanout, nodes[start : start + fanout]
            i //= fanout

    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            runs = [*path(trees[s], i), *path(top, k)]
            proof = h(*[n for at, run in runs for j, n in enumerate(run) if j != at])
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], proof, runs))
    return out


@pytest.mark.parametrize("fanout,levels,sizes", [(2, 1, [23, 1, 8, 2, 3]), (4, 2, [130, 1]), (16, 3, [20, 17, 1])])
def test_butterfly_against_plain_trees(spark, fanout, levels, sizes):
    r = random.Random(sum(sizes))
    rows, sources = [], [None, "b", "a", "é", "Z", "b2"]
    for s, n in zip(sources, sizes):
        rows += [(r.randint(0, 500), s, "en", k, f"Text {k}") for k in range(n)]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "b", None, None, None))
    r.shuffle(rows)
    df = manifest.leaves(spark.createDataFrame(rows, SCHEMA), presented={"text": F.upper("text")})
    got = [tuple(x) for x in manifest.manifest(df, fanout, levels, proofs=True).collect()]
    want = plain(rows, fanout)
    assert len(got) == len(want)
    # repeated rows differ in their places alone
    got.sort(key=lambda x: (str(x[0]), x[1], x[4], [p["at"] for p in x[7]]))
    want.sort(key=lambda x: (str(x[0]), x[1], x[4], [at for at, _ in x[5]]))
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert [(p["at"], p["nodes"]) for p in g[7]] == [(at, list(run)) for at, run in w[5]]
        assert manifest.fold(g[1], [(p["at"], p["nodes"]) for p in g[7]]) == g[3]
        # the presented text is in capitals; only a null one is the same
        assert g[6] == (g[0] is None) and (g[5] == g[3]) == g[6]


def test_tampering_hits_the_chosen_ids(spark):
    rows = [(i, "s", "en", 5, "ABC é" if i % 2 else "abc") for i in range(40)] + [(None, "s", "en", 1, "ABC")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {x["doc_id"]: x["verified"] for x in manifest.manifest(manifest.leaves(df, presented={"text": manifest.tampered(F.col("text"), F.col("doc_id"))})).collect()}
    assert out == {i: not (i is not None and i % 2 and zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows}


def test_lone_leaf_empty_table_and_clashing_columns(spark):
    one = spark.createDataFrame([(1, None, None, None, None, "x", 1, "y")], SCHEMA + ", leaf string, pos int, root string")
    (row,) = manifest.manifest(manifest.leaves(one)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == leaf((1, None, None, None, None)) and row["verified"]
    assert row["proof_sha256"] == h()
    assert manifest.manifest(manifest.leaves(one.limit(0))).count() == 0
    named = spark.createDataFrame([("a", "s"), ("b", "s")], "doc_id string, source string")
    assert manifest.manifest(manifest.leaves(named, fields=("doc_id", "source"))).filter("verified").count() == 2


def test_matches_sql(spark, sf, duck):
    from lithosense.llm.queries import ORACLES, QUERIES
    from tests.oracle_check import compare

    same, why = compare(QUERIES["op13_merkle_manifest"](spark, sf), duck, ORACLES["op13_merkle_manifest"])
    assert same, why
