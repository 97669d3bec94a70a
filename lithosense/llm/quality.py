"""Quality filter: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Symbols are all characters of the trusted text, one for characters that it never has and
one for text borders; the model has order 4.  Counts of four symbols are summed over
shards of the text; continuation counts, context totals and the joins of each order's
counts with the next lower order's probabilities are DataFrame operations.  The finished
tables, which hold the runs seen in the texts that are fitted on, go to every executor,
and each document is scored where it lies: runs of the 62 most frequent characters in a
dense table made from the model, all others by search in the sorted runs with back-off.

A document is kept unless its perplexity exceeds a quantile of the trusted documents of
its language.  Trusted documents are halved by hash: the model is fitted on the whole of one
half, the quantiles are taken over the whole other half, which the model has not seen.  The scores cover all documents.

Trusted are the documents labelled 1 and never otherwise.  A null language is a language
of its own; one without trusted documents takes the quantile over all.  Null and empty
texts have no perplexity and are kept, as is everything if nothing is trusted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lithosense.llm.common import ensure_importable, fresh, kept, texts, written
from lithosense.operators.quantiles import group_quantiles

ORDER, SYMBOLS = 4, 64  # symbols of the dense table; the model may have more
BITS = 21  # of a symbol in a context of up to three, as many as a code point takes
OTHER, BORDER = 0, 1
KEEP_QUANTILE = 0.99
_BORDERS = "\x02" * (ORDER - 1)


@dataclass
class Model:
    """Characters by falling frequency, and for each order seen runs (context, last symbol, probability) and seen contexts' weights."""

    alphabet: list[str]
    runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    weights: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @property
    def symbols(self) -> int:
        return max(SYMBOLS, len(self.alphabet) + 2)

    def key(self) -> bytes:
        return "".join(self.alphabet).encode("utf-32-le", "surrogatepass") + b"".join(a.tobytes() for part in self.runs for a in part)

    def dense(self) -> np.ndarray:
        """Log10 probability of every run of the first 64 symbols: seen ones as given, others from the lower order."""
        lower = np.full(SYMBOLS, 1.0 / self.symbols, np.float32)
        for n, ((before, last, p), (contexts, weight)) in enumerate(zip(self.runs, self.weights), 1):
            table = np.ones(SYMBOLS ** (n - 1), np.float32)
            at, few = _small(contexts, n - 1)
            table[at[few]] = weight[few]
            # a run's lower order is the run without its first symbol
            lower = (table.reshape(min(len(table), SYMBOLS), -1, 1) * lower.reshape(1, -1, SYMBOLS)).reshape(-1)
            at, few = _small(before, n - 1)
            few &= last < SYMBOLS
            lower[at[few] * SYMBOLS + last[few]] = p[few]
        return np.log10(lower, out=lower)


def _small(contexts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of contexts of ``n`` symbols in a dense table, and which contexts have one."""
    at, few = np.zeros(len(contexts), np.int64), np.ones(len(contexts), bool)
    for k in range(n - 1, -1, -1):
        symbol = (contexts >> (BITS * k)) & ((1 << BITS) - 1)
        few &= symbol < SYMBOLS
        at = at * SYMBOLS + np.minimum(symbol, SYMBOLS - 1)
    return at, few


class _Search:
    """The seen runs of a model in order, for runs that the dense table does not hold."""

    def __init__(self, model: Model):
        self.symbols = model.symbols
        self.orders = []
        for (before, last, p), (contexts, weight) in zip(model.runs, model.weights):
            order = np.argsort(contexts)
            contexts, weight = contexts[order], weight[order]
            keys = np.searchsorted(contexts, before) * self.symbols + last
            order = np.argsort(keys)
            self.orders.append((contexts, weight, keys[order], p[order]))

    def log10(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        p = np.full(len(last), 1.0 / self.symbols)
        for n, (contexts, weight, keys, seen) in enumerate(self.orders):
            mine = context & ((1 << (BITS * n)) - 1)
            at = np.minimum(np.searchsorted(contexts, mine), len(contexts) - 1)
            known = contexts[at] == mine
            key = at * self.symbols + last
            run = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            p = np.where(known & (keys[run] == key), seen[run], np.where(known, weight[at], 1.0) * p)
        return np.log10(p)


def _coder(alphabet: list[str]) -> np.ndarray:
    place = np.zeros(0x110000, np.int32)
    place[[ord(c) for c in alphabet]] = np.arange(2, 2 + len(alphabet))
    return place


def _symbols(rows: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some texts with borders between, and where each text's runs begin.

    A text has one run for each character and one for its end.
    """
    joined = _BORDERS + _BORDERS.join(rows) + _BORDERS[:1]
    symbols = place[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    at = np.concatenate([[0], np.cumsum(np.array([len(r) + ORDER - 1 for r in rows], np.int64))])
    for k in range(ORDER - 1):
        symbols[at[:-1] + k] = BORDER
    symbols[at[-1]] = BORDER
    return symbols, at


def _contexts(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The three symbols from each place on as one number."""
    out = np.zeros(len(at), np.int64)
    for k in range(ORDER - 1):
        out = (out << BITS) | symbols[at + k]
    return out


def _runs(symbols: np.ndarray, dense: np.ndarray, search: _Search) -> np.ndarray:
    """Log10 probability of the run of four symbols at each place."""
    n = len(symbols) - ORDER + 1
    many = symbols >= SYMBOLS
    rare = np.zeros(n, bool)
    few = np.where(many, 0, symbols).astype(np.uint32)
    codes = np.zeros(n, np.uint32)
    for k in range(ORDER):
        codes = codes * np.uint32(SYMBOLS) + few[k : k + n]
        rare |= many[k : k + n]
    out = dense[codes]
    where = np.flatnonzero(rare)
    if len(where):
        out[where] = search.log10(_contexts(symbols, where), symbols[where + ORDER - 1])
    return out


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, rows in texts(batch, "text"):
            points, n = np.unique(np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(points, pa.int64()), pa.array(n, pa.int64())], names=["point", "n"])


def _counter(alphabet: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = _coder(alphabet)
        for batch in batches:
            for _, rows in texts(batch, "text"):
                symbols, at = _symbols(rows, place)
                mine = np.concatenate([np.arange(a, a + len(r) + 1) for a, r in zip(at, rows)] or [np.zeros(0, np.int64)])
                contexts, number = np.unique(_contexts(symbols, mine), return_inverse=True)
                seen, n = np.unique((number.astype(np.int64) << BITS) | symbols[mine + ORDER - 1], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(contexts[seen >> BITS], pa.int64()), pa.array(seen & ((1 << BITS) - 1), pa.int64()), pa.array(n, pa.int64())],
                    names=["context", "last", "c"],
                )

    return run


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of counts 1 to 4."""
    row = counts.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(1, row[f"n{k}"]) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def fit(trusted: DataFrame, text_col: str = "text") -> Model | None:
    """The model of the texts; None if there is no character."""
    ensure_importable(trusted.sparkSession)
    rows = trusted.select(F.col(text_col).alias("text")).filter("text <> ''")
    points = rows.mapInArrow(_characters, "point bigint, n bigint").groupBy("point").agg(F.sum("n").alias("n"))
    # at most as many rows as there are code points
    frequent = points.orderBy(F.desc("n"), "point").collect()
    if not frequent:
        return None
    model = Model([chr(r["point"]) for r in frequent])
    top = rows.mapInArrow(_counter(model.alphabet), "context bigint, last bigint, c bigint").groupBy("context", "last").agg(F.sum("c").alias("c"))
    counts = {ORDER: written(top, "runs")}
    for n in range(ORDER - 1, 0, -1):
        # in how many different symbols' company a shorter run is seen
        counts[n] = counts[n + 1].groupBy((F.col("context") % F.lit(1 << BITS * (n - 1))).alias("context"), "last").agg(F.count(F.lit(1)).alias("c"))
    lower = None
    for n in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[n])
        discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        runs = counts[n].withColumn("d", discount)
        contexts = runs.groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"))
        runs = runs.join(contexts, "context")
        if lower is None:
            below = runs.withColumn("p0", F.lit(1.0 / model.symbols))
        else:
            shorter = lower.select(F.col("context").alias("suffix"), "last", F.col("p").alias("p0"))
            below = runs.withColumn("suffix", F.col("context") % F.lit(1 << BITS * (n - 2))).join(shorter, ["suffix", "last"])
        lower = written(below.select("context", "last", ((F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * F.col("p0")).alias("p")), "probabilities")
        seen, context = lower.toPandas(), contexts.select("context", "weight").toPandas()
        model.runs.append((seen["context"].to_numpy(np.int64), seen["last"].to_numpy(np.int32), seen["p"].to_numpy(np.float32)))
        model.weights.append((context["context"].to_numpy(np.int64), context["weight"].to_numpy(np.float32)))
    return model


def _tables(model: Model) -> tuple[np.ndarray, np.ndarray, _Search]:
    """The character codes, dense table and sorted runs of a model, made once in a worker process."""
    return kept(hashlib.sha256(model.key()).digest(), lambda: (_coder(model.alphabet), model.dense(), _Search(model)))


def score(df: DataFrame, model: Model, text_col: str = "text", carry: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """Columns ``carry`` with ``n_symbols`` and ``log10_perplexity`` (null for texts without characters)."""
    spark = df.sparkSession
    ensure_importable(spark)
    shared = spark.sparkContext.broadcast(model)
    names = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, dense, search = _tables(shared.value)
        for batch in batches:
            for start, rows in texts(batch, "text", 256):
                symbols, at = _symbols(rows, place)
                sums = np.concatenate([[0.0], np.cumsum(_runs(symbols, dense, search), dtype=np.float64)])
                n = np.array([len(r) + 1 for r in rows])
                mean = -(sums[at[:-1] + n] - sums[at[:-1]]) / n
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(start, len(rows)) for c in names), pa.array(n, pa.int64()), pa.array(mean, mask=n == 1)],
                    names=[*names, "n_symbols", "log10_perplexity"],
                )

    ddl = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names] + ["n_symbols bigint", "log10_perplexity double"])
    return df.select(*names, F.col(text_col).alias("text")).mapInArrow(run, ddl)


def _rows_of(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """Rows whose document is trusted.

    The ids grow with the table, so they are dealt by hash with the rows at every size: rows go
    through one shuffle, once, and are not sorted.
    """
    return rows.join(trusted.hint("shuffle_hash"), F.col("doc_id") == F.col("_trusted"), "left_semi")


def classify(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    label_col: str = "quality", keep_quantile: float = KEEP_QUANTILE,
) -> DataFrame:
    """Per row: ``doc_id, lang, log10_perplexity, threshold, kept``."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    trusted = labels.groupBy(F.col(id_col).alias("_trusted")).agg(F.min(label_col).alias("q")).filter("q = 1 AND _trusted IS NOT NULL").select("_trusted")
    trusted = written(trusted, "trusted")
    # one half is learnt from, the other shows what unseen good text looks like
    to_fit = F.pmod(F.xxhash64("_trusted"), F.lit(2)) == 0
    chosen = written(_rows_of(docs, trusted.filter(to_fit)).select("text"), "trusted-texts")
    model = fit(chosen)
    if model is None:
        return docs.select("doc_id", "lang", F.lit(None).cast("double").alias("log10_perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"))
    scored = written(score(docs, model).drop("n_symbols"), "perplexities")
    measured = _rows_of(scored, trusted.filter(~to_fit)).filter("log10_perplexity IS NOT NULL")
    measured = written(measured.select("lang", "log10_perplexity"), "measured")
    limits = lambda df, by: group_quantiles(df, by, "log10_perplexity", [keep_quantile], ["q"])
    by_lang = limits(measured, ["lang"]).select(F.col("lang").alias("_lang"), F.col("q").alias("own"))
    whole = limits(measured.withColumn("all", F.lit(0)), ["all"]).first()
    overall = whole["q"] if whole else None
    joined = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return joined.select(
        "doc_id", "lang", "log10_perplexity", limit.alias("threshold"), F.coalesce(F.col("log10_perplexity") <= limit, F.lit(True)).alias("kept")
    )


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``df`` that are kept; columns as they are.

    An id with several rows stays if one of them is kept; rows without an id are one such group.
    """
    (gone,) = fresh(df, "_rejected")
    verdicts = classify(df, labels, id_col, **options).groupBy(F.col("doc_id").alias(gone)).agg(F.max("kept").alias("k"))
    rejected = written(verdicts.filter("NOT k").select(gone), "rejected")
    return df.join(rejected, F.col(f"`{id_col}`").eqNullSafe(F.col(gone)), "left_anti")
