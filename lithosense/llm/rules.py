"""Quality rules: counts of a text's surface, and how much it reads like trusted text.

The verdict is a log-likelihood ratio.  Words and pairs of neighbouring words are hashed into
65,536 buckets (low half of their CRC-32); over the buckets stand two smoothed multinomials,
one of trusted texts, one of the whole raw corpus.  A text's score is the mean over its n-grams
of ``ln p(trusted) - ln p(raw)``.  Ratios are kept as whole multiples of 2^-20, so their sums are
exact and a score does not depend on the order of addition or on the partitioning.

Each document is held against a fixed limit, nothing is drawn by lot.  The limit of a language
comes from trusted documents that the multinomial has not seen: the median of their scores less
``SPREADS`` times the distance from it to their 1 % quantile.  A language with fewer than
``LEAST_HELD_OUT`` such documents takes the limit over all languages.

Trusted are ids that ``labels`` call good and never otherwise nor toxic.  Their halves are told
apart by hash; the multinomial is fitted on the ``max_fit_docs`` of the first half with the least
hash (a documented bound), the limits are taken over the whole other half, raw counts and scores
over all documents.  Scores are rounded down to 1/10,000, so that quantiles are read off a
histogram of bounded size.

Only DataFrame functions: n-grams are unfolded where the text lies, joined with the ratios (a
broadcast table of at most 65,536 rows) and summed again under the row's own columns, one partial
sum a row before the shuffle.  A very common word is combined map-side.

Defined cases: null and empty texts have no words and fail the base rule; so do texts of under
ten words.  Rows that are equal in id, language and text share one score and all come back.  A
null id is scored but never trusted, a null language is a language of its own.  Without trusted
documents the base rule alone decides.  Windows of five words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lithosense.llm.common import written

MAX_FIT_DOCS = 20_000
LEAST_HELD_OUT = 20
SPREADS = 2
WINDOW = 5
BUCKETS = 1 << 16
SCALE, STEPS = 1 << 20, 10_000

_BLANKS = "\t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur twice or more, each counted once.

    The windows' hashes are sorted with their places; those equal to a neighbour are repeats,
    and walking over their places adds what each covers beyond the one before.
    """
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    hashes = let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))

    def covered(by_hash: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return F.coalesce(F.get(by_hash, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(by_hash, i + 1)["h"] == x["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(by_hash, again), lambda x: x["i"]))
        start = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def count(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), let(by_hash, covered)).otherwise(0)

    return F.when(F.size(words) > width, let(hashes, count)).otherwise(0).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The base columns of one text (not null) and its words."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(" " + _BLANKS)) != "")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, " " + _BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _bucket(gram: Column) -> Column:
    return F.crc32(gram.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1))


def _grams(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and for every word the buckets of it (``one``) and of it with the next (``two``).

    A row more, with null buckets, stands for the text itself (``end``).
    """
    at = df.select(*keys, "words", F.explode_outer(F.sequence(F.lit(0), F.size("words"))).alias("_i"))
    word, following = F.get("words", F.col("_i")), F.get("words", F.col("_i") + 1)
    return at.select(*keys, _bucket(word).alias("one"), _bucket(F.concat(word, F.lit(" "), following)).alias("two"), (F.col("_i") == F.size("words")).alias("end"))


def _trusted(labels: DataFrame, id_col: str) -> DataFrame:
    """``_trusted, _fit``: trusted ids and whether they belong to the half that is learnt from."""
    good = labels.groupBy(F.col(f"`{id_col}`").alias("_trusted")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")
    )
    key = F.md5(F.col("_trusted").cast("string").cast("binary"))
    return good.filter("q = 1 AND t = 0 AND _trusted IS NOT NULL").select("_trusted", key.alias("_key")).withColumn("_fit", F.col("_key") < "8")


def ratios(worded: DataFrame, trusted: DataFrame, max_fit_docs: int = MAX_FIT_DOCS) -> DataFrame:
    """``bucket, ratio``: the scaled log-likelihood ratio of each bucket that occurs."""
    sample = trusted.filter("_fit").orderBy("_key", "_trusted").limit(max_fit_docs).select("_trusted", F.lit(1).alias("_t"))
    # at most max_fit_docs ids, whatever the data
    marked = worded.join(F.broadcast(sample), F.col("id") == F.col("_trusted"), "left")
    grams = _grams(marked, ["_t"]).select("_t", F.explode_outer(F.array("one", "two")).alias("bucket")).filter("bucket IS NOT NULL")
    counts = written(grams.groupBy("bucket").agg(F.count("_t").alias("t"), F.count(F.lit(1)).alias("r")), "buckets")
    total_t, total_r = counts.agg(F.sum("t")).scalar(), counts.agg(F.sum("r")).scalar()
    trust, raw = ((F.col(c) + 1) / (total + BUCKETS) for c, total in (("t", total_t), ("r", total_r)))
    return counts.select("bucket", F.round((F.ln(trust) - F.ln(raw)) * SCALE).cast("long").alias("ratio"))


def scores(worded: DataFrame, ratio: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, how many rows have them (``copies``), and their ``score`` in steps of 1/10,000 (null without words)."""
    def ratio_of(gram: str) -> DataFrame:
        # at most 65,536 rows
        return F.broadcast(ratio.select(F.col("bucket").alias(gram), F.col("ratio").alias(f"_{gram}")))

    both = _grams(worded, keys).join(ratio_of("one"), "one", "left").join(ratio_of("two"), "two", "left")
    total = F.sum(F.coalesce("_one", F.lit(0)) + F.coalesce("_two", F.lit(0)))
    summed = both.groupBy(*keys).agg(total.alias("s"), (F.count("one") + F.count("two")).alias("n"), F.count_if("end").alias("copies"))
    return summed.withColumn("score", F.floor(F.col("s") * float(STEPS) / F.nullif(F.col("n") * float(SCALE), F.lit(0.0))).cast("long")).drop("s", "n")


def _limit(scored: DataFrame, by: list[str]) -> DataFrame:
    """``by``, ``n`` and ``limit`` from the histogram of scores."""
    histogram = scored.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = histogram.withColumns({"upto": F.sum("c").over(whole.orderBy("score")), "n": F.sum("c").over(whole)})

    def rank(share: float) -> Column:
        return F.min(F.when(F.col("upto") > F.floor((F.col("n") - 1) * share), F.col("score")))

    ends = upto.groupBy(*by).agg(F.max("n").alias("n"), rank(0.5).alias("mid"), rank(0.01).alias("low"))
    return ends.select(*by, "n", (F.col("mid") - SPREADS * (F.col("mid") - F.col("low"))).alias("limit"))


def classify(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_fit_docs: int = MAX_FIT_DOCS
) -> DataFrame:
    """Per row: ``doc_id``, the measures, ``base_failed``, ``score`` and ``limit`` (ratio a n-gram), ``kept``."""
    docs = df.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )
    worded = docs.withColumn("words", words_of(F.col("text")))
    trusted = written(_trusted(labels, id_col), "trusted")
    ratio = written(ratios(worded.select("id", "words"), trusted, max_fit_docs), "ratios")
    keys = ["id", "lang", "content", *MEASURES]
    measured = worded.select("id", "lang", F.xxhash64("text").alias("content"), "words", *[c.alias(n) for n, c in measures(F.col("text"), F.col("words")).items()])
    scored = written(scores(measured, ratio, keys), "scores")
    held_out = scored.join(trusted.filter("NOT _fit"), F.col("id") == F.col("_trusted"), "left_semi").filter("score IS NOT NULL")
    held_out = written(held_out.select("lang", "score"), "held-out")
    own = _limit(held_out, ["lang"]).filter(f"n >= {LEAST_HELD_OUT}").select(F.col("lang").alias("_lang"), F.col("limit").alias("own"))
    limit = F.coalesce(F.col("own"), _limit(held_out, []).select("limit").scalar())
    rows = scored.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn("limit", limit)
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).withColumn("base_failed", base_failed())
    kept = ~F.col("base_failed") & F.coalesce(F.col("score") >= F.col("limit"), F.lit(True))
    return rows.select(
        F.col("id").alias("doc_id"), *MEASURES, "base_failed", (F.col("score") / STEPS).alias("score"), (F.col("limit") / STEPS).alias("limit"), kept.alias("kept")
    )
