"""Near-duplicate detection with HyperMinHash sketches.

Each text's shingle set is hashed into 256 buckets; a bucket's register keeps the leading
zeros and ten mantissa bits of its smallest hash.  Empty buckets borrow the register of a
filled one, chosen by fixed priorities, so equal registers stay as likely as the sets are
similar, for short texts too.  Bands of five registers propose links.

Texts with equal sets are one class from the start; only class representatives go on.  In
every band bucket each member is held against one centre, the member that meets most
others, and what this links is joined into components.  So a big group of near copies
costs one comparison a member.

Then every bucket takes as its centre the hub of its centre's component: the member with
most company of all, the original among its near copies.  Only pairs of different
components are still wanted, and distances to the hub rule most of them out:

* both near the hub: they share no more than what each shares with it, and what they share
  outside of it; the latter is joined shingle by shingle, and near the hub it is rare;
* one far from the hub, the other linked to it: further apart than a link, as Jaccard
  distance is a metric;
* one far, the other not linked: where few such members of fitting size meet in a bucket, each is
  held against each; where many do, they go through a prefix filter.  Of sets with
  similarity t the first ``(1 - t) * n + 1`` shingles share one, in any fixed order; shingles that
  only one component has come first, then rare before common ones.  So members that share
  a template, but have a fifth of their text to themselves, meet nobody.

No link is lost.  A pair first passes the collision-corrected estimate from the registers
(with a wide margin), then the exact comparison of both whole sets.

A pair at similarity 0.8 shares none of the 40 bands with probability 2e-7.

Defined cases: null and empty texts have an empty set, link with nothing and are kept; a
text of fewer words than a shingle has its whole sequence as its only shingle; rows that
share an id are one document, joined by the links of each; a null id is kept and links
with nothing.  Ids may be of any type that has an order; whole numbers come back as long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.llm.common import ensure_importable, fresh, release, written
from lithosense.llm.links import components, merged
from lithosense.llm.words import chunks, mix, shingle_sets

BUCKETS, MANTISSA_BITS = 256, 10
BANDS, ROWS = 40, 5
FEW = 8  # members of a bucket, of fitting size, that are held against each other without a look at their shingles
MARGIN = 0.4  # how far below the threshold an estimate may lie before a pair is given up; half of it is 4 deviations

_PRIORITY = np.argsort(np.random.default_rng(7).random((BUCKETS, BUCKETS)), axis=1).astype(np.uint16)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The 256 registers of a sorted set of hashes (not empty).

    The top byte of a hash names its bucket, so in sorted order the first of each bucket
    is its smallest.
    """
    bucket = (shingles >> np.uint64(56)).astype(np.intp)
    filled, first = np.unique(bucket, return_index=True)
    rest = (shingles[first] << np.uint64(8)) | np.uint64(1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(63, np.maximum(0, 64 - exponent)).astype(np.uint16)
    mantissa = ((fraction - 0.5) * (2 << MANTISSA_BITS)).astype(np.uint16)
    out = np.zeros(BUCKETS, np.uint16)
    out[filled] = (zeros << np.uint16(MANTISSA_BITS)) | mantissa
    if len(filled) < BUCKETS:
        empty = np.setdiff1d(np.arange(BUCKETS), filled, assume_unique=True)
        out[empty] = out[filled[_PRIORITY[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """Band hashes (rows of sketches × bands)."""
    grid = regs[:, : BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), grid.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(1 << 16) + grid[:, :, k])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers, less the matches that different minima make by chance.

    Two different minima agree when both their leading zeros (probability 1/3, were all
    buckets of one size) and their mantissas do.
    """
    chance = 2.0**-MANTISSA_BITS / 3
    same = (a == b).mean(axis=1)
    return (same - chance) / (1 - chance)


def sketches(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, n_shingles, f1, f2, regs``: set size, 128-bit fingerprint of the set, registers (null if empty)."""
    ensure_importable(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for row, part in chunks(batch.column("text")):
                sets = shingle_sets(part, width)
                sums = [(mix(s, 11).sum(dtype=np.uint64), mix(s, 12).sum(dtype=np.uint64)) for s in sets]
                f = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(row, len(sets)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(f[:, 0]),
                        pa.array(f[:, 1]),
                        pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["id", "n_shingles", "f1", "f2", "regs"],
                )

    rows = df.select(_id(df, id_col).alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, f"id {_kind(rows)}, n_shingles bigint, f1 bigint, f2 bigint, regs binary")


def _id(df: DataFrame, id_col: str) -> Column:
    """The id as it is; whole numbers as long."""
    whole = df.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.col(f"`{id_col}`").cast("long") if whole else F.col(f"`{id_col}`")


def _kind(df: DataFrame, column: str = "id") -> str:
    return df.schema[column].dataType.simpleString()


def _bands(representatives: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(part.num_rows, BUCKETS)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
                yield pa.RecordBatch.from_arrays([pa.array(band_keys(regs).ravel()), ids], names=["key", "id"])

    return representatives.select("id", "regs").mapInArrow(run, f"key bigint, id {_kind(representatives)}")


def _estimated(pairs: DataFrame, regs: DataFrame, threshold: int) -> DataFrame:
    """``a, b, near``: whether the estimated similarity leaves a chance that the pair is linked."""
    least = threshold / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(part.num_rows, BUCKETS) for c in ("ra", "rb"))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(estimate(a, b) >= least)], names=["a", "b", "near"])

    known = regs.select("id", "regs")
    both = pairs.join(known.select(F.col("id").alias("b"), F.col("regs").alias("rb")), "b").join(
        known.select(F.col("id").alias("a"), F.col("regs").alias("ra")), "a"
    )
    return both.select("a", "b", "ra", "rb").mapInArrow(run, f"a {_kind(regs)}, b {_kind(regs)}, near boolean")


def _compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``a, b, na, nb, both, outside``: sizes of the whole sets and their overlap, and what only ``b`` has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                left, right = ([s for _, c in chunks(part.column(n)) for s in shingle_sets(c, width)] for n in ("ta", "tb"))
                outside = [np.setdiff1d(y, x, assume_unique=True) for x, y in zip(left, right)]
                sizes = [[len(x) for x in left], [len(y) for y in right], [len(y) - len(o) for y, o in zip(right, outside)]]
                flat = np.concatenate([np.zeros(0, np.uint64), *outside]).view(np.int64)
                ends = np.concatenate([[0], np.cumsum([len(o) for o in outside])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), *(pa.array(n, pa.int64()) for n in sizes), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["a", "b", "na", "nb", "both", "outside"],
                )

    whole = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"
    )
    return whole.select("a", "b", "ta", "tb").mapInArrow(
        run, f"a {_kind(texts)}, b {_kind(texts)}, na bigint, nb bigint, both bigint, outside array<bigint>"
    )


def _linked(pairs: DataFrame, threshold: int) -> Column:
    return 100 * F.col("both") >= threshold * (F.col("na") + F.col("nb") - F.col("both"))


def _near_the_hub(compared: DataFrame, label: DataFrame, threshold: int) -> DataFrame:
    """``a, b``: pairs near one hub that may be linked, of different components.

    Let both members share ``i`` and ``j`` shingles with hub C, and ``t`` with each other that C has not.  They share at
    most ``min(i, j) + t``.  So they either share some shingle outside of C, or are linked by
    ``min(i, j)`` alone, which limits the partner's size to a few values (an equi-join on
    those).  One of the two is itself not linked to C.

    A link of a text of ``n`` shingles holds at least ``threshold * n`` of them, so ``t`` is at least
    that less ``i``.  A prefix filter uses it: of its shingles outside of C that other components have
    too, rare ones first, a text meets others only by as many as it can do without, and one
    more.  They meet by the first shingle they share if by any, and then share at most what either has
    from there on.  Pairs for which that is enough are counted whole.
    """
    t, all_ = threshold, 100 + threshold
    centred = compared.select(F.col("a").alias("c"), F.col("b").alias("id"), F.col("nb").alias("n"), F.col("both").alias("i"), F.col("na").alias("nc"), "outside")
    centred = centred.join(label, "id", "left").withColumn("component", F.coalesce("component", "id"))
    centred = written(centred.withColumn("open", all_ * F.col("i") < t * (F.col("n") + F.col("nc"))), "centred")
    x = centred.filter("open").select("c", F.col("id").alias("a"), F.col("n").alias("n1"), F.col("i").alias("i1"), F.col("component").alias("p"))
    y = centred.select("c", F.col("id").alias("b"), F.col("n").alias("n2"), F.col("i").alias("i2"), F.col("component").alias("q"))
    different = (F.col("p") != F.col("q")) & (all_ * F.least("n1", "n2") >= t * (F.col("n1") + F.col("n2")))

    tokens = centred.select("c", "id", "component", "n", "i", "open", F.explode("outside").alias("s"))
    met = tokens.groupBy("c", "s").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high"), F.bool_or("open").alias("wanted"))
    met = met.filter("wanted AND low <> high").select("c", "s", "m")
    rare_first = F.sort_array(F.collect_list(F.struct("m", "s")))
    own = tokens.join(met, ["c", "s"]).groupBy("c", "id", "component", "n", "i", "open").agg(rare_first.alias("common"))
    least = F.greatest(F.lit(1), F.ceil(t * F.col("n") / 100).cast("int") - F.col("i").cast("int"))
    own = written(own.withColumn("first", F.size("common") - least + 1).filter("first > 0"), "outside")
    prefix = _numbered(own, F.col("first"), "c", "id", "component", "n", "i", "open")
    left = prefix.filter("open").select("c", F.col("id").alias("a"), F.col("n").alias("n1"), F.col("i").alias("i1"), F.col("component").alias("p"), F.col("rest").alias("r1"), "s")
    right = prefix.select("c", F.col("id").alias("b"), F.col("n").alias("n2"), F.col("i").alias("i2"), F.col("component").alias("q"), F.col("rest").alias("r2"), "s")
    enough = all_ * (F.least("i1", "i2") + F.least("r1", "r2")) >= t * (F.col("n1") + F.col("n2"))
    meet = left.join(right, ["c", "s"]).filter(different & enough).select("c", "a", "n1", "i1", "b", "n2", "i2").distinct()
    of = lambda name, n, i, held: own.select("c", F.col("id").alias(name), F.col("n").alias(n), F.col("i").alias(i), F.col("common.s").alias(held))
    shared = (
        meet.join(of("a", "n1", "i1", "sa"), ["c", "a", "n1", "i1"])
        .join(of("b", "n2", "i2", "sb"), ["c", "b", "n2", "i2"])
        .filter(all_ * (F.least("i1", "i2") + F.size(F.array_intersect("sa", "sb"))) >= t * (F.col("n1") + F.col("n2")))
    )
    low, high = F.ceil(t * F.col("n1") / 100), F.floor(all_ * F.col("i1") / t) - F.col("n1")
    sized = (
        x.filter(low <= high).withColumn("n2", F.explode(F.sequence(low, high)))
        .join(y, ["c", "n2"])
        .filter(different & (all_ * F.least("i1", "i2") >= t * (F.col("n1") + F.col("n2"))))
    )
    return shared.select("a", "b").unionByName(sized.select("a", "b"))


def _numbered(own: DataFrame, first: Column, *kept: str) -> DataFrame:
    """``kept``, ``s``, ``rest``: the first shingles of each list ``common``, and how many the list has from each on, itself included.

    Two lists in one order share no more than the smaller ``rest`` of the first shingle they share.
    """
    at = own.select(*kept, F.size("common").alias("rest"), F.posexplode(F.slice("common", F.lit(1), first.cast("int"))).alias("at", "x"))
    return at.select(*kept, F.col("x.s").alias("s"), (F.col("rest") - F.col("at")).alias("rest"))


def _shingles(texts: DataFrame, width: int) -> DataFrame:
    """``id, k, n, s``: each shingle of each text; ``k`` tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, part in chunks(batch.column("text")):
                sets = shingle_sets(part, width)
                sizes = [len(x) for x in sets]
                ids = batch.column("id").slice(row, len(sets)).take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
                k = batch.column("k").slice(row, len(sets)).take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
                n, s = pa.array(np.repeat(np.array(sizes, np.int64), sizes)), pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids, k, n, s], names=["id", "k", "n", "s"])

    return texts.select("id", F.xxhash64("text").alias("k"), "text").mapInArrow(run, f"id {_kind(texts)}, k bigint, n bigint, s bigint")


def _far_from_the_hub(open_bands: DataFrame, estimated: DataFrame, compared: DataFrame, label: DataFrame, sizes: DataFrame, texts: DataFrame, width: int, threshold: int) -> DataFrame:
    """``a, b``: pairs of different components, one of them far from the hub of a bucket they share, the other not linked to it."""
    distance = estimated.select(F.col("a").alias("centre"), F.col("b").alias("id"), (~F.col("near")).alias("far"))
    linked = compared.filter(_linked(compared, threshold)).select(F.col("a").alias("centre"), F.col("b").alias("id"))
    apart = open_bands.filter("id <> centre").join(distance, ["centre", "id"]).join(linked, ["centre", "id"], "left_anti")
    apart = apart.join(label, "id", "left").select("key", "id", "far", F.coalesce("component", "id").alias("component")).join(sizes, "id")
    # a bucket's members by size: steps in which a link is too wide for two, each member in its own and the next, so that two that fit meet
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / threshold + 1e-9)) if threshold < 100 else F.col("n")
    apart = apart.withColumn("step", F.explode(F.array(step, step + 1)))
    # buckets where such a pair can be
    open_ = apart.groupBy("key", "step").agg(F.bool_or("far").alias("far"), F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("met"))
    apart = written(apart.join(open_.filter("far AND low <> high").select("key", "step", "met"), ["key", "step"]), "apart")
    all_, whole = 100 + threshold, threshold * (F.col("n1") + F.col("n2"))
    few = apart.filter(F.col("met") <= FEW)
    side = lambda name, component, n, far: few.select("key", "step", F.col("id").alias(name), F.col("component").alias(component), F.col("n").alias(n), F.col("far").alias(far))
    direct = side("a", "p", "n1", "far1").join(side("b", "q", "n2", "far2"), ["key", "step"])
    direct = direct.filter((F.col("a") < F.col("b")) & (F.col("p") != F.col("q")) & (F.col("far1") | F.col("far2")) & (all_ * F.least("n1", "n2") >= whole)).select("a", "b").distinct()
    # of larger groups no pairs are listed; only their members' shingles are looked at
    members = written(apart.filter(F.col("met") > FEW).groupBy("id").agg(F.first("component").alias("component")), "apart-many")
    if members.isEmpty():
        return direct
    tokens = written(_shingles(texts.join(members.select("id"), "id", "left_semi"), width).join(members, "id"), "apart-shingles")
    shared = tokens.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("s", "c")
    # a text's shingles that others have too, rare ones first; those of one component stand before them in the order
    own = tokens.join(shared, "s").groupBy("id", "k", "component", "n").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("common"))
    first = F.col("n") - F.ceil(threshold * F.col("n") / 100).cast("long") + 1 - (F.col("n") - F.size("common"))
    prefix = _numbered(own.filter(first > 0), first, "id", "component", "n")
    left = prefix.select(F.col("id").alias("a"), F.col("component").alias("p"), F.col("n").alias("n1"), F.col("rest").alias("r1"), "s")
    right = prefix.select(F.col("id").alias("b"), F.col("component").alias("q"), F.col("n").alias("n2"), F.col("rest").alias("r2"), "s")
    enough = all_ * F.least("n1", "n2", "r1", "r2") >= whole
    return direct.unionByName(left.join(right, "s").filter((F.col("a") < F.col("b")) & (F.col("p") != F.col("q")) & enough).select("a", "b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: int = 80) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * |A ∩ B| >= threshold * |A ∪ B|`` for their sets of
    ``width``-word shingles; a component's id is its smallest document id, which is kept.
    """
    sketched = written(sketches(df, id_col, text_col, width), "sketches")
    usable = sketched.filter("regs IS NOT NULL AND id IS NOT NULL")
    classes = usable.groupBy("f1", "f2", "n_shingles").agg(F.min("id").alias("rep"))
    # an id with several rows may stand for several classes: the rows are joined by their id
    in_class = usable.join(classes, ["f1", "f2", "n_shingles"])
    representatives = in_class.filter("id = rep").groupBy("id", "f1", "f2", "n_shingles").agg(F.first("regs").alias("regs"))
    bands = _bands(representatives)
    shared = bands.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members")).filter("low < high")
    members = written(bands.join(shared.select("key", "members"), "key"), "bands")
    degrees = written(members.groupBy("id").agg(F.sum("members").alias("degree")), "degrees")
    wanted = degrees.select("id")
    texts = written(df.select(_id(df, id_col).alias("id"), F.col(f"`{text_col}`").alias("text")).join(wanted, "id", "left_semi"), "texts")
    regs = written(representatives.join(wanted, "id", "left_semi").select("id", "regs", F.col("n_shingles").alias("n")), "registers")
    sizes = regs.select("id", "n").distinct()

    # the centre of a bucket is its member with the most company: the original among its near copies
    best = F.min(F.struct((-F.col("degree")).alias("minus"), "id"))
    centres = members.join(degrees, "id").groupBy("key").agg(best.alias("best"))
    open_bands = written(members.join(centres, "key").select("key", "id", F.col("best.id").alias("centre")), "open-bands")
    star = lambda buckets: buckets.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    estimated = written(_estimated(star(open_bands), regs, threshold), "estimates")
    compared = written(_compared(estimated.filter("near"), texts, width), "compared")
    linked = lambda pairs: pairs.filter(_linked(pairs, threshold)).select("a", "b")
    label = written(components(linked(compared)), "labels")

    # now the hub of a centre's component takes its place
    hubs = label.join(degrees, "id").groupBy("component").agg(best.alias("best"))
    hub_of = label.join(hubs, "component").select(F.col("id").alias("centre"), F.col("best.id").alias("hub"))
    around = written(open_bands.join(hub_of, "centre", "left").select("key", "id", F.coalesce("hub", "centre").alias("centre")), "hubs")
    hub_star = written(star(around).join(estimated.withColumnRenamed("near", "known"), ["a", "b"], "left"), "hub-star")
    more = written(_estimated(hub_star.filter("known IS NULL").select("a", "b"), regs, threshold), "hub-estimates")
    more_compared = written(_compared(more.filter("near"), texts, width), "hub-compared")
    label = merged(label, linked(more_compared))
    near_hub = compared.join(hub_star.filter("known").select("a", "b"), ["a", "b"], "left_semi").unionByName(more_compared)
    at_hub = hub_star.filter("known IS NOT NULL").select("a", "b", F.col("known").alias("near")).unionByName(more)
    pairs = _near_the_hub(near_hub, label, threshold).unionByName(
        _far_from_the_hub(around, at_hub, near_hub, label, sizes, texts, width, threshold)
    )
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "remaining")
    if not pairs.isEmpty():
        rest = _estimated(pairs, regs, threshold)
        label = merged(label, written(linked(_compared(rest.filter("near"), texts, width)), "late-links"))
    # rows of one id that stand for several classes, and members of a class, follow its representative
    labels = merged(label, in_class.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b")))
    component = F.coalesce("component", "id")
    return sketched.join(labels, "id", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``df`` whose document is the smallest of its component; columns as they are."""
    (gone,) = fresh(df, "_gone")
    dropped = near_duplicates(df, id_col, **options).filter("NOT kept").select(F.col("doc_id").alias(gone)).distinct()
    return df.join(dropped, _id(df, id_col) == F.col(gone), "left_anti")
