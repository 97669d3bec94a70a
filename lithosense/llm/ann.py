"""Approximate nearest neighbours by largest inner product, with a hierarchical k-means tree.

Vectors get one more component that gives all the same length, so the largest inner
product is the smallest distance.  A tree of k-means splits is fitted on at most
``max_fit`` vectors (those of smallest hash); every vector is then put into its leaf.  A
query walks the tree best bin first: a priority queue holds the nodes seen so far by their
centre's distance, and leaves are visited in the order they come out.  How many leaves are
visited is widened until the mean recall of ``calibration`` queries, whose true neighbours
are found by comparing them with every vector, reaches ``recall``.

Leaves are packed into blocks of about ``block_rows`` vectors (a larger leaf takes several),
and a query goes once to each block that holds leaves it visits.  Hot leaves and many
queries at one leaf are thus spread over tasks.

Vectors that are null, empty, zero, or hold null or non-finite components take no part,
nor do those of another length than most.  Ties go to the smaller id.  Scores are inner
products of the original vectors in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lithosense.llm.common import ensure_importable, partitions_for, written

MAX_FIT, BRANCHES, LEAF_SAMPLE = 32_768, 8, 48
CALIBRATION, RECALL = 128, 0.97
BLOCK_ROWS, QUERY_ROWS = 4096, 8192


class Tree:
    """Centres of all nodes, children of inner ones, and the numbers of leaves."""

    def __init__(self, points: np.ndarray, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE, seed: int = 3):
        self._rng = np.random.default_rng(seed)
        centres, self.children, pending = [points.mean(axis=0)], [[]], [(0, points)]
        while pending:
            node, mine = pending.pop()
            parts = self._split(mine, branches) if len(mine) > leaf_sample else []
            for part in parts:
                self.children[node].append(len(centres))
                pending.append((len(centres), part))
                centres.append(part.mean(axis=0))
                self.children.append([])
        self.centres = np.array(centres)
        self.norms = (self.centres**2).sum(axis=1)
        leaves = [k for k, c in enumerate(self.children) if not c]
        self.leaf = {node: i for i, node in enumerate(leaves)}
        self.leaves = len(leaves)

    def _split(self, points: np.ndarray, branches: int) -> list[np.ndarray]:
        """K-means; empty if the points cannot be told apart."""
        centres = np.unique(points[self._rng.choice(len(points), min(len(points), branches), replace=False)], axis=0)
        for _ in range(12):
            group = self._nearest(points, centres)
            centres = np.array([points[group == k].mean(axis=0) for k in np.unique(group)])
        group = self._nearest(points, centres)
        parts = [points[group == k] for k in np.unique(group)]
        return parts if len(parts) > 1 else []

    @staticmethod
    def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf each point falls into, going to the nearest child at every node."""
        out = np.zeros(len(points), np.int32)
        pending = [(0, np.arange(len(points)))]
        while pending:
            node, rows = pending.pop()
            if not len(rows):
                continue
            if node in self.leaf:
                out[rows] = self.leaf[node]
                continue
            children = self.children[node]
            to = self._nearest(points[rows], self.centres[children])
            pending += [(child, rows[to == k]) for k, child in enumerate(children)]
        return out

    def visit(self, points: np.ndarray, most: int, held: np.ndarray | None = None, least: int = 0) -> list[list[int]]:
        """For each point the first ``most`` leaves, best bin first.

        With ``held``, the stored vectors of each leaf, the walk goes on until its leaves
        hold ``least`` of them, or no leaf is left.
        """
        distance = self.norms - 2 * points @ self.centres.T
        out = []
        for d in distance:
            found: list[int] = []
            short = least if held is not None else 0
            queue = [(d[0], 0)]
            while queue and (len(found) < most or short > 0):
                _, node = heapq.heappop(queue)
                if node in self.leaf:
                    found.append(self.leaf[node])
                    short -= held[self.leaf[node]] if held is not None else 0
                for child in self.children[node]:
                    heapq.heappush(queue, (d[child], child))
            out.append(found)
        return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lengthen(vectors: np.ndarray, largest: float) -> np.ndarray:
    """With the component that brings every squared length to ``largest``."""
    rest = np.sqrt(np.maximum(0, largest - (vectors**2).sum(axis=1)))
    return np.column_stack([vectors, rest])


def _query_side(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors, np.zeros(len(vectors))])


def top(query: np.ndarray, own: int | None, ids: np.ndarray, vectors: np.ndarray, approximate: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best ids and scores for one query; sums are taken in one order, so equal vectors tie."""
    keep = ids != own if own is not None else np.ones(len(ids), bool)
    at = np.flatnonzero(keep)
    if len(at) > k:
        least = np.partition(approximate[at], len(at) - k)[len(at) - k]
        at = at[approximate[at] >= least - 1e-9 * (1 + abs(least))]
    exact = (vectors[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -exact))[:k]
    return ids[at][order], exact[order]


_FOUND = "query_id bigint, vec_id bigint, score double"


def _found(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    query = np.concatenate([np.zeros(0, np.int64), *[np.full(len(i), q, np.int64) for q, i, _ in parts]])
    ids = np.concatenate([np.zeros(0, np.int64), *[i for _, i, _ in parts]])
    scores = np.concatenate([np.zeros(0), *[s for _, _, s in parts]])
    return pa.table([pa.array(query), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_neighbours(vectors: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """Brute force for a fixed list of queries: each task keeps the ``k`` best of its batches."""
    ids = [q for q, _ in queries]
    shared = vectors.sparkSession.sparkContext.broadcast(np.array([v for _, v in queries]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            if batch.num_rows:
                mine, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("vec"), points.shape[1])
                near = points @ matrix.T
                yield from _found([(q, *top(points[i], q, mine, matrix, near[i], k)) for i, q in enumerate(ids)]).to_batches()

    return _best(vectors.select("vec_id", "vec").mapInArrow(run, _FOUND), k)


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, vec`` of the vectors that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("vec_id IS NOT NULL")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    good = rows.filter(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0))
    size = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("vec") == (size["n"] if size else 0))


def search(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, max_fit: int = MAX_FIT,
    calibration: int = CALIBRATION, recall: float = RECALL, block_rows: int = BLOCK_ROWS, leaf_sample: int = LEAF_SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row where ``is_query`` (on ``vec_id``).

    A walk ends no sooner than its leaves hold ``k`` vectors and the query's own, so every
    query gets ``k`` rows, or all candidates where there are fewer.
    """
    spark = df.sparkSession
    ensure_importable(spark)
    vectors = written(usable(df, id_col, vec_col), "vectors")
    facts = vectors.agg(
        F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("largest"), F.max(F.size("vec")).alias("dim"), F.count_if(is_query).alias("queries")
    ).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if not facts["queries"]:
        return empty
    largest, dim = facts["largest"], facts["dim"]
    by_hash = vectors.orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = np.array([r["vec"] for r in by_hash.limit(max_fit).toLocalIterator()])
    tree = Tree(_lengthen(sample, largest), leaf_sample=leaf_sample)
    shared = spark.sparkContext.broadcast(tree)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = shared.value.place(_lengthen(_matrix(batch.column("vec"), dim), largest))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column("vec_id"), batch.column("vec")], names=["leaf", "vec_id", "vec"])

    index = written(vectors.mapInArrow(put, "leaf int, vec_id bigint, vec array<double>"), "leaves")

    probes = [(r["vec_id"], np.array(r["vec"])) for r in by_hash.filter(is_query).limit(calibration).collect()]
    truth = exact_neighbours(vectors, probes, k).select("query_id", "vec_id")
    in_leaf = truth.join(index.select("vec_id", "leaf"), "vec_id").groupBy("query_id", "leaf").count().collect()
    visits = _calibrate(tree, probes, [(r["query_id"], r["leaf"], r["count"]) for r in in_leaf], recall)

    sizes = dict(index.groupBy("leaf").count().toLocalIterator())
    first, parts = _pack(tree.leaves, sizes, block_rows)
    held = np.array([sizes.get(leaf, 0) for leaf in range(tree.leaves)])
    query_parts = partitions_for(facts["queries"], QUERY_ROWS)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at, leaves in enumerate(shared.value.visit(_query_side(_matrix(batch.column("vec"), dim)), visits, held, k + 1)):
                blocks: dict[int, list[int]] = {}
                for leaf in leaves:
                    for part in range(parts[leaf]):
                        blocks.setdefault(first[leaf] + part, []).append(leaf)
                rows += [(b, at, mine) for b, mine in blocks.items()]
            where = pa.array([r[1] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), batch.column("part").take(where), batch.column("query_id").take(where), batch.column("vec").take(where), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
                names=["block", "part", "query_id", "vec", "leaves"],
            )

    part_of = F.pmod(F.xxhash64("vec_id"), F.lit(query_parts)).cast("int").alias("part")
    queries = vectors.filter(is_query).select(F.col("vec_id").alias("query_id"), "vec", part_of)
    sent = queries.mapInArrow(walk, "block int, part int, query_id bigint, vec array<double>, leaves array<int>")
    places = spark.createDataFrame([(leaf, int(first[leaf]), int(parts[leaf])) for leaf in range(tree.leaves)], "leaf int, first int, parts int")
    # as many rows as the tree has leaves, which max_fit bounds
    blocks = index.join(F.broadcast(places), "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("part"), "leaf", "vec_id", "vec",
    )

    def compare(asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not asked.num_rows or not stored.num_rows:
            return _found([])
        ids, matrix = stored.column("vec_id").to_numpy(), _matrix(stored.column("vec").combine_chunks(), dim)
        leaf = stored.column("leaf").to_numpy()
        out = []
        points = _matrix(asked.column("vec").combine_chunks(), dim)
        wanted = asked.column("leaves").to_pylist()
        for start in range(0, len(points), 512):
            near = points[start : start + 512] @ matrix.T
            for i, (query, mine) in enumerate(zip(asked.column("query_id").to_numpy()[start : start + 512], wanted[start : start + 512])):
                at = np.flatnonzero(np.isin(leaf, mine))
                out.append((query, *top(points[start + i], query, ids[at], matrix[at], near[i][at], k)))
        return _found(out)

    found = sent.groupBy("block", "part").cogroup(blocks.groupBy("block", "part")).applyInArrow(compare, _FOUND)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrate(tree: Tree, probes: list[tuple[int, np.ndarray]], truth: list[tuple[int, int, int]], recall: float) -> int:
    """The fewest leaves that find the wanted share of the true neighbours."""
    order = tree.visit(_query_side(np.array([v for _, v in probes])), tree.leaves)
    turn = {q: {leaf: n for n, leaf in enumerate(leaves)} for (q, _), leaves in zip(probes, order)}
    gained = np.zeros(tree.leaves)
    for query, leaf, n in truth:
        gained[turn[query][leaf]] += n
    if not gained.sum():
        return tree.leaves
    share = np.cumsum(gained) / gained.sum()
    return int(np.searchsorted(share, recall)) + 1


def _pack(leaves: int, sizes: dict[int, int], block_rows: int) -> tuple[list[int], list[int]]:
    """First block and number of blocks of every leaf; small leaves share a block."""
    first, parts, block, used = [], [], 0, 0
    for leaf in range(leaves):
        n = sizes.get(leaf, 0)
        if n > block_rows or used + n > block_rows:
            block, used = block + (used > 0), 0
        count = max(1, -(-n // block_rows))
        first.append(block)
        parts.append(count)
        if count > 1:
            block, used = block + count, 0
        else:
            used += n
    return first, parts
