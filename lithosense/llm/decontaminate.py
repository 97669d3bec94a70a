"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share word seeds are tiled: the longest run of words
that both have, and that no tile covers yet, becomes a tile, again and again, down to
``least`` words.  Runs are found by Karp-Rabin window hashes.  The share of the item's
words under tiles tells how much of it the document holds, in whatever order.

The seeds of the benchmark travel to the documents in blocks of bounded size, so the
documents, which may be any number and length, are not shuffled, and a benchmark of any
size is covered by as many blocks as it takes.  A pair is tiled only if its seeds could
cover enough of the item, which loses nothing.

Null texts are empty.  Items of fewer than ``least`` words count where they stand whole; items
without words match nothing.  Rows that share an id, or have none, are judged each by its
own text.  Ids may be of any type.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from lithosense.llm.common import ensure_importable, fresh, release, written
from lithosense.llm.words import chunks, windows, words

LEAST, COVERAGE = 4, 0.6
BLOCK_WORDS = 1_000_000


def _runs(doc: np.ndarray, item: np.ndarray, free_doc: np.ndarray, free_item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal common runs of at least ``size`` uncovered words: (length, place in doc, place in item)."""
    if len(doc) < size or len(item) < size:
        return []
    blocked = [np.concatenate([[0], np.cumsum(~f)]) for f in (free_doc, free_item)]
    open_doc, open_item = (np.flatnonzero(b[size:] == b[:-size]) for b in blocked)
    if not len(open_doc) or not len(open_item):
        return []
    hashes_doc, hashes_item = windows(doc, size)[open_doc], windows(item, size)[open_item]
    places: dict[int, list[int]] = {}
    for h, j in zip(hashes_item.tolist(), open_item.tolist()):
        places.setdefault(h, []).append(j)
    out = []
    for k in np.flatnonzero(np.isin(hashes_doc, hashes_item)).tolist():
        i = int(open_doc[k])
        for j in places[int(hashes_doc[k])]:
            if i and j and free_doc[i - 1] and free_item[j - 1] and doc[i - 1] == item[j - 1]:
                continue  # part of a run that starts earlier
            n = 0
            while i + n < len(doc) and j + n < len(item) and free_doc[i + n] and free_item[j + n] and doc[i + n] == item[j + n]:
                n += 1
            if n >= size:
                out.append((n, i, j))
    return out


def tiles(doc: np.ndarray, item: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: (length, place in doc, place in item), longest first."""
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    out: list[tuple[int, int, int]] = []
    size = max(least, min(20, len(item)))
    while True:
        runs = sorted(_runs(doc, item, free_doc, free_item, size), key=lambda r: (-r[0], r[1], r[2]))
        if runs and runs[0][0] > 2 * size:
            size = runs[0][0]
            continue
        heap = [(-n, i, j) for n, i, j in runs]
        heapq.heapify(heap)
        while heap:
            n, i, j = heapq.heappop(heap)
            free = free_doc[i : i - n] & free_item[j : j - n]
            if free.all():
                free_doc[i : i - n] = free_item[j : j - n] = False
                out.append((-n, i, j))
                continue
            # what a tile has left of this run takes its turn among runs of its length
            edges = np.flatnonzero(np.diff(np.concatenate([[0], free.astype(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                if b - a >= size:
                    heapq.heappush(heap, (a - b, i + a, j + a))
        if size == least:
            return out
        size = max(least, size // 2)


class _Block:
    """Some items' words, and where each seed stands in them."""

    def __init__(self, ids: list, sequences: list[np.ndarray], least: int):
        self.ids, self.sequences = ids, sequences
        # items shorter than a seed, by their length: hash of the whole and item
        self.short: dict[int, dict[int, list[int]]] = {}
        for k, s in enumerate(sequences):
            if len(s) < least:
                self.short.setdefault(len(s), {}).setdefault(int(windows(s, len(s))[0]), []).append(k)
        seeds = [windows(s, least) if len(s) >= least else np.zeros(0, np.uint64) for s in sequences]
        flat = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(flat, kind="stable")
        self.item = np.repeat(np.arange(len(ids)), [len(s) for s in seeds])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(s)) for s in seeds]])[order]
        self.seeds, self.start = np.unique(flat[order], return_index=True)
        self.stop = np.append(self.start[1:], len(flat))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.seeds >> np.uint64(44)] = True
        self.lengths = np.array([len(s) for s in sequences])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows that are seeds: their places and the seeds' numbers."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        if not len(self.seeds) or not len(at):
            return at[:0], at[:0]
        number = np.minimum(np.searchsorted(self.seeds, hashes[at]), len(self.seeds) - 1)
        hit = self.seeds[number] == hashes[at]
        return at[hit], number[hit]

    def whole(self, words_: np.ndarray) -> list[int]:
        """Short items that stand whole in a text."""
        out = []
        for size, items in self.short.items():
            if len(words_) >= size:
                there = set(windows(words_, size).tolist()) & items.keys()
                out += [k for h in there for k in items[h]]
        return sorted(out)

    def likely(self, numbers: np.ndarray, least: int, coverage: float) -> list[int]:
        """Items that these seeds could cover far enough."""
        numbers = np.unique(numbers)
        rows = np.concatenate([np.arange(self.start[k], self.stop[k]) for k in numbers])
        item, place = self.item[rows], self.place[rows]
        out = []
        for k in np.unique(item):
            places = np.sort(place[item == k])
            covered = least + np.minimum(np.diff(places), least).sum()
            if covered >= coverage * self.lengths[k]:
                out.append(int(k))
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, least: int, block_words: int) -> Iterator[_Block]:
    """The benchmark in blocks of about ``block_words`` words, one at a time on the driver."""
    items = benchmark.select(_id(benchmark, id_col).alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ids: list = []
    sequences: list[np.ndarray] = []
    size = 0
    for row in items.toLocalIterator():
        sequence = words(pa.array([row["text"]], pa.large_string())).hashes
        if not len(sequence):
            continue
        if ids and size + len(sequence) > block_words:
            yield _Block(ids, sequences, least)
            ids, sequences, size = [], [], 0
        ids.append(row["id"])
        sequences.append(sequence)
        size += len(sequence)
    if ids:
        yield _Block(ids, sequences, least)


def _id(df: DataFrame, id_col: str) -> Column:
    """The id as it is; whole numbers as long."""
    whole = df.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.col(f"`{id_col}`").cast("long") if whole else F.col(f"`{id_col}`")


def _matches(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    least: int = LEAST, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """As ``matches``, with ``content``, the hash of the row's text, which tells rows of one id apart."""
    spark = df.sparkSession
    ensure_importable(spark)
    text = F.col(f"`{text_col}`")
    docs = df.select(_id(df, id_col).alias("doc_id"), F.xxhash64(text).alias("content"), text.alias("text"))
    kinds = [docs.schema["doc_id"].dataType, benchmark.select(_id(benchmark, item_col).alias("i")).schema["i"].dataType]
    ddl = f"doc_id {kinds[0].simpleString()}, content bigint, item_id {kinds[1].simpleString()}, coverage double, n_tiles int, longest int"
    found = None
    for block in _blocks(benchmark, item_col, item_text_col, least, block_words):
        part = docs.mapInArrow(_tiler(spark.sparkContext.broadcast(block), least, coverage, kinds), ddl)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], ddl)


def matches(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, coverage, n_tiles, longest`` for pairs whose tiles cover ``coverage`` of the item's words.

    Options: ``id_col``, ``text_col``, ``item_col``, ``item_text_col``, ``least`` (words a tile), ``coverage``, ``block_words``.
    """
    return _matches(df, benchmark, **options).drop("content")


def _tiler(shared, least: int, coverage: float, kinds: list[DataType]):
    types = (to_arrow_type(kinds[0]), pa.int64(), to_arrow_type(kinds[1]), pa.float64(), pa.int32(), pa.int32())
    names = ["doc_id", "content", "item_id", "coverage", "n_tiles", "longest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        block: _Block = shared.value
        for batch in batches:
            out: list[tuple] = []
            for row, part in chunks(batch.column("text")):
                w = words(part)
                keys = list(zip(*(batch.column(c).slice(row, len(part)).to_pylist() for c in ("doc_id", "content"))))
                if block.short:
                    for d, key in enumerate(keys):
                        for k in block.whole(w.hashes[w.first[d] : w.first[d + 1]]):
                            out.append((*key, block.ids[k], 1.0, 1, int(block.lengths[k])))
                if len(w.hashes) < least:
                    continue
                at, number = block.find(windows(w.hashes, least))
                doc = np.searchsorted(w.first, at, "right") - 1
                inside = at + least <= w.first[doc + 1]
                at, number, doc = at[inside], number[inside], doc[inside]
                edges = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else []
                for a, b in zip(edges, [*edges[1:], len(doc)]):
                    d = int(doc[a])
                    sequence = w.hashes[w.first[d] : w.first[d + 1]]
                    for k in block.likely(number[a:b], least, coverage):
                        found = tiles(sequence, block.sequences[k], least)
                        share = sum(t[0] for t in found) / block.lengths[k]
                        if share >= coverage:
                            out.append((*keys[d], block.ids[k], float(share), len(found), found[0][0] if found else 0))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

    return run


def by_document(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row of ``df``: ``doc_id, contaminated, coverage`` (the largest), ``item_ids`` (sorted)."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    pairs = _matches(df, benchmark, **options).groupBy(F.col("doc_id").alias("_id"), F.col("content").alias("_content")).agg(
        F.max("coverage").alias("coverage"), F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    rows = df.select(_id(df, id_col).alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("content"))
    return rows.join(pairs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")), "left").select(
        "doc_id", F.col("_content").isNotNull().alias("contaminated"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"), "item_ids"
    )


def drop_contaminated(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``df`` that hold no benchmark item; columns as they are."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    bad_id, bad_content = fresh(df, "_bad", "_content")
    # written, so that Spark knows how few they are before it chooses to shuffle the texts
    bad = written(_matches(df, benchmark, **options).select(F.col("doc_id").alias(bad_id), F.col("content").alias(bad_content)).distinct(), "contaminated")
    return df.join(bad, _id(df, id_col).eqNullSafe(F.col(bad_id)) & (F.xxhash64(f"`{text_col}`") == F.col(bad_content)), "left_anti")
