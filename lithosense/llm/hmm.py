"""Hidden Markov language model.

A word belongs to a class: the most frequent words have one each, all others share one by
their last three bytes.  Latent states emit classes; a class emits its words by their
discounted counts, and what the discount takes off is the share of unknown words.  So the
model gives every text, known words or not, a probability.

Learning: word counts are summed over all training texts and stay a distributed table.
Baum-Welch runs over all training texts in every sweep; partitions add up expected counts,
which are summed by entry, and only the tables of the states (their size is fixed by
states and classes) reach the driver.  Within a sweep long texts are cut into windows of
256 words.  Scoring cuts nothing: the scaled forward recursion runs over whole texts.

For scoring, texts are dealt into buckets of a few megabytes; every bucket's distinct words
are joined with the counts, and both meet again by bucket.

Null texts are empty and consist of their end only.  A null id counts as the empty text
when training texts are chosen.  Without training texts every word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.llm.common import ensure_importable, input_bytes, partitions_for, written
from lithosense.llm.words import Words, chunks, mix, words

STATES, SWEEPS, WINDOW = 8, 5, 256
FREQUENT, ENDINGS = 4096, 1024
END_CLASS = FREQUENT + ENDINGS
CLASSES = END_CLASS + 1
END_HASH = np.uint64(1)
FREQUENT_COUNT = 10  # rarer words share a class, which also holds the unknown ones
PRIOR_TOKENS = 20.0  # weight of the shares of classes over all text in each state's emissions
DISCOUNT = 0.75
BUCKET_BYTES = 16 << 20


def is_held_out(id_col: Column, fold: int = 2, folds: int = 7) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds == fold


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    """Word hashes of each text followed by its end, and where each text begins."""
    w = words(column)
    n = np.diff(w.first)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(first[-1], END_HASH, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[first[1:] - 1] = False
    out[is_word] = w.hashes
    return out, first, w


def _ending(w: Words) -> np.ndarray:
    """Class of each word by its last three bytes."""
    code = np.zeros(len(w.start), np.uint64)
    for k in (3, 2, 1):
        at = w.end - k
        code = code * np.uint64(257) + np.where(at >= w.start, w.data[np.maximum(at, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return FREQUENT + (mix(code, 5) % np.uint64(ENDINGS)).astype(np.int64)


class _Classes:
    """Classes of words, given the hashes of the frequent ones."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.sort(frequent)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.order >> np.uint64(44)] = True

    def of(self, hashes: np.ndarray, first: np.ndarray, w: Words) -> np.ndarray:
        out = np.full(len(hashes), END_CLASS, np.int64)
        is_word = np.ones(len(out), bool)
        is_word[first[1:] - 1] = False
        out[is_word] = _ending(w)
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(44)] & is_word) if len(self.order) else np.zeros(0, np.int64)
        if len(at):
            place = np.minimum(np.searchsorted(self.order, hashes[at]), len(self.order) - 1)
            hit = self.order[place] == hashes[at]
            out[at[hit]] = place[hit]
        return out


@dataclass
class Model:
    """States: first, next, emitted classes.  Classes: tokens and types in training texts.  Frequent words' hashes."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    tokens: np.ndarray
    types: np.ndarray
    frequent: np.ndarray
    n: int
    v: int


def _initial(tokens: np.ndarray, states: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    emit = share * rng.gamma(2.0, 0.5, (states, len(tokens)))
    move = np.full((states, states), 0.1 / max(1, states - 1)) + np.eye(states) * 0.9
    return np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)


def _by_length(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences from long to short, and how many are still running at each step."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    return order, len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")


def log_forward(classes: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Log10 probability of each class sequence, by the scaled forward recursion, all sequences in step."""
    lengths = np.diff(first)
    order, running = _by_length(lengths)
    at = first[:-1][order]
    by_class = np.ascontiguousarray(emit.T)
    alpha = np.tile(start, (len(order), 1))
    out = np.zeros(len(order))
    for t, m in enumerate(running):
        now = alpha[:m] if t == 0 else alpha[:m] @ move
        now = now * by_class[classes[at[:m] + t]]
        scale = now.sum(axis=1)
        alpha[:m] = now / scale[:, None]
        out[:m] += np.log10(scale)
    back = np.empty_like(out)
    back[order] = out
    return back


def expected_counts(classes: np.ndarray, first: np.ndarray, fresh: np.ndarray, start: np.ndarray, occupied: np.ndarray, move: np.ndarray, emit: np.ndarray):
    """Baum-Welch: expected starts, moves and emissions over some windows.

    ``fresh`` tells windows that begin a text; others begin in a state drawn by ``occupied``.
    """
    lengths = np.diff(first)
    order, running = _by_length(lengths)
    at, fresh = first[:-1][order], fresh[order]
    states, n_classes = emit.shape
    by_class = np.ascontiguousarray(emit.T)
    alphas, scales = [], []
    for t, m in enumerate(running):
        now = np.where(fresh[:m, None], start, occupied) if t == 0 else alphas[-1][:m] @ move
        now = now * by_class[classes[at[:m] + t]]
        scale = now.sum(axis=1)
        alphas.append(now / scale[:, None])
        scales.append(scale)
    starts, moves, emitted = np.zeros(states), np.zeros((states, states)), np.zeros((states, n_classes))
    beta = np.zeros((0, states))
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        if t + 1 < len(running):
            k = running[t + 1]
            ahead = by_class[classes[at[:k] + t + 1]] * beta / scales[t + 1][:, None]
            moves += alphas[t][:k].T @ ahead
            beta = np.concatenate([ahead @ move.T, np.ones((m - k, states))])
        else:
            beta = np.ones((m, states))
        gamma = alphas[t] * beta
        gamma /= gamma.sum(axis=1, keepdims=True)
        alphas[t] = gamma
        if t == 0:
            starts = gamma[fresh].sum(axis=0)
    where = np.concatenate([classes[at[:m] + t] for t, m in enumerate(running)] or [np.zeros(0, np.int64)])
    gammas = np.concatenate(alphas) if alphas else np.zeros((0, states))
    for k in range(states):
        emitted[k] = np.bincount(where, weights=gammas[:, k], minlength=n_classes)
    return starts, moves * move, emitted


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts every ``WINDOW`` tokens: where windows begin, and which begin a text."""
    pieces = -(-np.diff(first) // WINDOW)
    text = np.repeat(np.arange(len(pieces)), pieces)
    number = np.arange(len(text)) - np.repeat(np.concatenate([[0], np.cumsum(pieces)[:-1]]), pieces)
    return np.append(first[:-1][text] + number * WINDOW, first[-1]), number == 0


def _distinct(hashes: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once, with its class and the sum of its counts."""
    found, place, group = np.unique(hashes, return_index=True, return_inverse=True)
    return found, classes[place], np.bincount(group, weights=counts, minlength=len(found)).astype(np.int64)


def _emit(bucket: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    if parts:
        hashes, classes, counts = _distinct(*map(np.concatenate, zip(*parts)))
        for k in range(0, len(hashes), 65_536):
            part = slice(k, k + 65_536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(hashes[part]), bucket, np.int32)), pa.array(hashes[part].view(np.int64)), pa.array(classes[part].astype(np.int32)), pa.array(counts[part])],
                names=["bucket", "h", "class", "n"],
            )


def _dictionary(docs: DataFrame) -> DataFrame:
    """``bucket, h, class, n``: each bucket's distinct words, with their class by ending and training count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = -1, []
        for batch in batches:
            buckets, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "held_out"))
            for row, part in chunks(batch.column("text")):
                hashes, first, w = _tokens(part)
                n = np.diff(first)
                text = slice(row, row + len(part))
                ending = np.full(len(hashes), END_CLASS, np.int32)
                is_word = np.ones(len(hashes), bool)
                is_word[first[1:] - 1] = False
                ending[is_word] = _ending(w)
                trained = np.repeat(~held[text], n)
                # rows come in the order of their buckets, so one is complete when the next begins
                edges = np.flatnonzero(np.diff(buckets[text], prepend=buckets[row] - 1))
                for a, b in zip(edges, [*edges[1:], len(n)]):
                    if buckets[row + a] != bucket:
                        yield from _emit(bucket, parts)
                        bucket, parts = int(buckets[row + a]), []
                    mine = slice(first[a], first[b])
                    parts.append(_distinct(hashes[mine], ending[mine], trained[mine].astype(np.int64)))
                    if len(parts) == 8:
                        parts = [_distinct(*map(np.concatenate, zip(*parts)))]
        yield from _emit(bucket, parts)

    dealt = docs.select("bucket", "held_out", "text").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, h bigint, class int, n bigint")


def _sequences(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """The classes of whole chunks of training texts, packed: ``classes`` (16 bits each) and ``lengths``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Classes(shared.value)
        for batch in batches:
            for _, part in chunks(batch.column("text")):
                hashes, first, w = _tokens(part)
                packed = known.of(hashes, first, w).astype(np.uint16).tobytes(), np.diff(first).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in packed], names=["classes", "lengths"])

    return docs.filter("NOT held_out").select("text").mapInArrow(run, "classes binary, lengths binary")


def _sweep(sequences: DataFrame, start: np.ndarray, occupied: np.ndarray, move: np.ndarray, emit: np.ndarray):
    """One pass of Baum-Welch over all training texts; expected counts are summed by entry."""
    states, n_classes = emit.shape
    shared = sequences.sparkSession.sparkContext.broadcast((start, occupied, move, emit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(states + states * states + states * n_classes)
        for batch in batches:
            for packed, sizes in zip(batch.column("classes").to_pylist(), batch.column("lengths").to_pylist()):
                classes = np.frombuffer(packed, np.uint16).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
                cut, fresh = _windows(first)
                total += np.concatenate([a.ravel() for a in expected_counts(classes, cut, fresh, *shared.value)])
        entries = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(entries.astype(np.int32)), pa.array(total[entries])], names=["entry", "x"])

    summed = sequences.mapInArrow(run, "entry int, x double").groupBy("entry").agg(F.sum("x").alias("x")).toPandas()
    total = np.zeros(states + states * states + states * n_classes)
    total[summed["entry"].to_numpy()] = summed["x"].to_numpy()
    return total[:states], total[states : states + states * states].reshape(states, states), total[states + states * states :].reshape(states, n_classes)


def fit(docs: DataFrame, counts: DataFrame, states: int = STATES, sweeps: int = SWEEPS, seed: int = 5) -> Model:
    """Learn from the training rows of ``docs`` and the word counts ``h, class, c`` over them."""
    known = counts.filter("c > 0")
    by_class = known.groupBy("class").agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types")).toPandas()
    frequent = known.filter((F.col("class") != END_CLASS) & (F.col("c") >= FREQUENT_COUNT)).orderBy(F.desc("c"), "h").limit(FREQUENT).select("h", "class", "c").toPandas()
    hashes = np.sort(frequent["h"].to_numpy(np.int64).view(np.uint64))
    tokens, types = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    tokens[by_class["class"]], types[by_class["class"]] = by_class["tokens"], by_class["types"]
    n, v = int(tokens.sum()), int(types.sum())
    np.subtract.at(tokens, frequent["class"].to_numpy(int), frequent["c"].to_numpy(int))
    np.subtract.at(types, frequent["class"].to_numpy(int), 1)
    place = np.searchsorted(hashes, frequent["h"].to_numpy(np.int64).view(np.uint64))
    tokens[place], types[place] = frequent["c"].to_numpy(int), 1
    start, move, emit = _initial(tokens, states, seed)
    occupied = start
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    sequences = written(_sequences(docs, hashes), "sequences")
    for _ in range(sweeps if n else 0):
        starts, moves, emitted = _sweep(sequences, start, occupied, move, emit)
        occupied = (emitted.sum(axis=1) + 1 / states) / (emitted.sum() + 1)
        start = (starts + 1 / states) / (starts.sum() + 1)
        move = (moves + 1 / states) / (moves.sum(axis=1, keepdims=True) + 1)
        emit = (emitted + PRIOR_TOKENS * share) / (emitted.sum(axis=1, keepdims=True) + PRIOR_TOKENS)
    return Model(start, move, emit, tokens, types, hashes, n, v)


def word_log10(model: Model, classes: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Log10 probability of words within their classes, from their training counts.

    A frequent word and the end are all of their class.  Elsewhere ``DISCOUNT`` is taken off
    every count and given to the unknown words of the class.
    """
    tokens, types = model.tokens[classes], model.types[classes]
    shared = (classes >= FREQUENT) & (classes < END_CLASS)
    with np.errstate(divide="ignore", invalid="ignore"):
        p = np.where(c > 0, (c - DISCOUNT) / tokens, np.where(tokens > 0, DISCOUNT * types / tokens, 1.0))
    return np.where(shared, np.log10(np.where(shared, p, 1.0)), 0.0)


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None, **options) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows where ``held_out`` (by default the id's CRC modulo 7 is 2) are scored, not learnt from.
    """
    spark = df.sparkSession
    ensure_importable(spark)
    n_buckets = partitions_for(input_bytes(df, text_col), BUCKET_BYTES)
    held_out = is_held_out(F.col(id_col)) if held_out is None else held_out
    docs = df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.length(text_col)), F.lit(n_buckets)).cast("int").alias("bucket"),
    )
    dictionary = written(_dictionary(docs), "dictionary")
    counts = written(dictionary.groupBy("h").agg(F.min("class").alias("class"), F.sum("n").alias("c")), "counts")
    model = fit(docs, counts, **options)
    shared = spark.sparkContext.broadcast(model)
    looked_up = dictionary.select("bucket", "h").join(counts.select("h", "c"), "h")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model: Model = shared.value
        h = right.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, c = h[order], right.column("c").to_numpy()[order]
        known = _Classes(model.frequent)
        text = left.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        out = [[] for _ in range(4)]
        for _, part in chunks(text):
            hashes, first, w = _tokens(part)
            classes = known.of(hashes, first, w)
            count = c[np.searchsorted(h, hashes)]
            begin = first[:-1]
            out[0].append(np.diff(first))
            out[1].append(np.add.reduceat((count > 0).astype(np.int64), begin))
            out[2].append(np.add.reduceat(np.log10(count + 1.0), begin))
            out[3].append(np.add.reduceat(word_log10(model, classes, count), begin) + log_forward(classes, first, model.start, model.move, model.emit))
        n, seen, base, full = (np.concatenate(x) for x in out)
        base = base - n * np.log10(float(model.n + model.v + 1))
        size = len(n)
        return pa.table(
            [left.column("doc_id"), left.column("held_out"), pa.array(n), pa.array(seen), pa.array(np.full(size, model.n)), pa.array(base), pa.array(full)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    kind = df.schema[id_col].dataType.simpleString()
    return docs.groupBy("bucket").cogroup(looked_up.groupBy("bucket")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )
