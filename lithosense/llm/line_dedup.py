"""Near-duplicate lines by a deletion-neighbourhood join.

Lines are compared without surrounding blanks and case.  The edit bound is a share of the
length: one inserted, removed or replaced character for lines of at least ``min_fuzzy_chars``,
none for shorter ones.  A line goes if an earlier one (by document id, then place) is its
duplicate.

Rows are numbered once, in the order of their ids, and a line's place is one number made of
the row's and its own; so rows that share an id, or have none, are cleaned each by itself.

Equal lines meet by hash.  For the others every line would emit all its variants with one
character removed; two lines within the bound share one.  As one of their halves is then
equal, only lines that share a half with another emit variants, and only those with
the other half touched.  Equal variants are joined; lines that lack a character at the
same place differ by a replacement, a line that equals a variant of another by an
insertion.  What meets is verified by edit distance, and the earliest is kept.

Blank lines are no duplicates of anything.  Null texts stay null.  A null id sorts first.  Of
rows with one id the order is that of their texts' hashes; rows repeated whole (id and text)
have one number and are cleaned alike.  Lines of any length take part.  Ids may be of any type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lithosense.llm.common import ensure_importable, fresh, release, written
from lithosense.llm.words import mix

MIN_FUZZY_CHARS = 20
_BLANKS = " \t\r\v\f"
_LINE = ["h1", "h2"]


_ROW_BITS = 33  # of a partition's own numbers in monotonically_increasing_id


def _norm(line: Column) -> Column:
    return F.lower(F.trim(line, F.lit(_BLANKS)))


class Places:
    """A table's rows numbered by id, and the whole numbers that stand for places of lines.

    A place is (partition, row, line) in one number, so places have the order of rows and
    lines, and the earliest of equal lines is a minimum of numbers.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        self.columns, self.text_col = df.columns, text_col
        self.row, content, id_, key = fresh(df, "_row", "_content", "_id", "_key")
        marked = df.withColumn(content, F.xxhash64(F.col(f"`{text_col}`")))
        order = [F.col(id_).asc_nulls_first(), F.col(key)]
        rows = marked.select(F.col(f"`{id_col}`").alias(id_), F.col(content).alias(key)).distinct()
        numbers = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(self.row, F.monotonically_increasing_id())
        numbers = written(numbers, "numbers")
        same = F.col(f"`{id_col}`").eqNullSafe(F.col(id_)) & (F.col(content) == F.col(key))
        self.table = written(marked.join(numbers.hint("shuffle_hash"), same).drop(content, id_, key), "numbered")
        part, own = F.shiftright(F.col(self.row), _ROW_BITS), F.col(self.row).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        most = self.table.agg(F.max(part), F.max(own), F.max(F.size(self.split()))).first()
        part_bits, self.own_bits, self.line_bits = (max(0, v or 0).bit_length() for v in most)
        if part_bits + self.own_bits + self.line_bits > 63:
            raise ValueError("more rows and lines than 63 bits can number")
        self.code = F.shiftleft(part, self.own_bits).bitwiseOR(own)

    def split(self) -> Column:
        return F.split(F.col(f"`{self.text_col}`"), "\n", -1)

    def raw(self) -> DataFrame:
        """``place, line`` for every line."""
        rows = self.table.select(self.code.alias("code"), F.posexplode(self.split()).alias("pos", "line"))
        return rows.select(F.shiftleft("code", self.line_bits).bitwiseOR(F.col("pos")).alias("place"), "line")

    def lines(self) -> DataFrame:
        """``place, norm, h1, h2`` for every line that is not blank; the two hashes name the line."""
        norm = self.raw().select("place", _norm(F.col("line")).alias("norm")).filter("norm <> ''")
        return norm.withColumns({"h1": F.xxhash64("norm"), "h2": F.hash("norm")})

    def row_of(self, place: Column) -> Column:
        return F.shiftright(place, self.line_bits)

    def line_of(self, place: Column) -> Column:
        return place.bitwiseAND(F.lit((1 << self.line_bits) - 1)).cast("int")


def _sizes(norm: Column) -> tuple[Column, Column]:
    """Lengths of a line's halves: half of this line, and half of one a character shorter.

    Lines one edit apart have one length in common; lengths from 16 are cut to a multiple of
    8, so most lines have one length.
    """

    def cut(h: Column) -> Column:
        return F.when(h < 16, h).otherwise(h - h % 8).cast("int")

    n = F.length(norm)
    return cut(F.floor(n / 2)), cut(F.floor((n - 1) / 2))


def _half_keys(norm: Column) -> list[Column]:
    """Keys of a line's halves (left, right, and for the second length again, null if it is the first): for lines
    one edit apart, one key is the same."""
    sizes = _sizes(norm)
    out = []
    for i, h in enumerate(sizes):
        pair = [F.xxhash64(F.lit(0), h, F.left(norm, h)), F.xxhash64(F.lit(1), h, F.right(norm, h))]
        out += pair if i == 0 else [F.when(sizes[0] != h, key) for key in pair]
    return out


def _halves(norm: Column) -> Column:
    """The halves as an array of (side, size, key)."""
    sizes = _sizes(norm)
    return F.array(*[F.struct(F.lit(k % 2).alias("side"), sizes[k // 2].alias("size"), key.alias("key")) for k, key in enumerate(_half_keys(norm))])


def _polynomials(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all prefixes and suffixes of a string, and the powers that join them."""
    n = len(codes)
    values = mix(codes.astype(np.uint64), 3)
    power = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, np.uint64(0x9E3779B97F4A7C15)), out=power[1:])
    weighted = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=weighted[1:])
    return weighted, power, values


def variants(line: str, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of ``line`` without the character at each place in ``low..high-1``, as runs of equal variants.

    Removing any character of a run of equal ones gives one variant; it is returned once
    with the first and last place of the run inside the range.
    """
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    weighted, power, _ = _polynomials(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[low + 1 : high] != codes[low : high - 1]])) + low if high > low else np.zeros(0, np.int64)
    last = np.concatenate([first[1:] - 1, [high - 1]]) if len(first) else first
    # characters behind the gap move one place forward: multiply the prefix instead of dividing the rest
    hashes = weighted[first] * power[1] + (weighted[-1] - weighted[first + 1])
    return mix(hashes, len(codes) - 1), first, last


def whole(line: str) -> int:
    """The hash under which a line meets its longer neighbours' variants."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32)
    weighted, power, _ = _polynomials(codes)
    return mix(weighted[-1:] * power[1], len(codes))[0]


_SENT = pa.schema([("v", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("place", pa.int64())])
_SENT_DDL = "v bigint, low int, high int, place bigint"


def _neighbourhood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Variants of each line for each half it shares, and the line itself (``low`` -1)."""
    release()
    for batch in batches:
        parts: list[tuple] = []
        size = 0
        for row in batch.to_pylist():
            line, n = row["norm"], len(row["norm"])
            for half in row["halves"]:
                low, high = (half["size"], n) if half["side"] == 0 else (0, n - half["size"])
                v, first, last = variants(line, low, high)
                v = np.append(v, np.uint64(whole(line)))
                first, last = np.append(first, -1), np.append(last, -1)
                parts.append((mix(v ^ np.uint64(half["key"] % (1 << 64))).view(np.int64), first, last, row["place"]))
                size += len(v)
            if size > 100_000:
                yield _pack(parts)
                parts, size = [], 0
        if parts:
            yield _pack(parts)


def _pack(parts: list[tuple]) -> pa.RecordBatch:
    v, low, high = (np.concatenate([p[k] for p in parts]) for k in range(3))
    place = np.repeat(np.array([p[3] for p in parts], np.int64), [len(p[0]) for p in parts])
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(place)], schema=_SENT)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of ``v``: pairs of lines one edit apart, later and earlier.

    A variant is met by at most one line for each character that can fill each of its gaps,
    so a group does not grow with the table.
    """
    group: list[tuple] = []
    for batch in batches:
        v = batch.column("v").to_numpy()
        same = np.concatenate([[bool(group) and group[-1][0] == v[0]], v[1:] == v[:-1]]) if len(v) else np.zeros(0, bool)
        # only rows with an equal neighbour matter; the last may have one in the next batch
        wanted = same.copy()
        wanted[:-1] |= same[1:]
        if len(v):
            wanted[-1] = True
        out: list[tuple] = []
        kept = batch.filter(pa.array(wanted))
        for row in zip(*(kept.column(c).to_pylist() for c in ("v", "low", "high", "place"))):
            if group and group[-1][0] != row[0]:
                out += _pairs(group)
                group = []
            group.append(row)
        yield _pair_batch(out)
    yield _pair_batch(_pairs(group))


def _pairs(group: list[tuple]) -> list[tuple]:
    """(later, earlier) places of rows (v, low, high, place) that one variant brought together."""
    if len(group) < 2:
        return []
    found = set()

    def link(a: int, b: int) -> None:
        if a != b:
            found.add((max(a, b), min(a, b)))

    selves = [place for _, low, _, place in group if low < 0]
    removed = sorted((place, low, high) for _, low, high, place in group if low >= 0)
    for s in selves:
        for place, _, _ in removed:
            link(s, place)
    earliest: dict[int, int] = {}
    for place, low, high in removed:
        for gap in range(low, high + 1):
            link(earliest.setdefault(gap, place), place)
    return list(found)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(2)], names=["late", "early"])


def _near(raw: DataFrame, distinct: DataFrame) -> DataFrame:
    """``late, near``: places of lines (at their first occurrence) with an earlier line one edit away, and the earliest found."""
    halves = distinct.select("place", F.explode(F.array_compact(F.array(*_KEYS))).alias("key"))
    shared = halves.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    owners = halves.join(shared, "key").groupBy("place").agg(F.collect_set("key").alias("keys"))
    # a fixed kind of join where texts travel: the plan, and so the disk it takes, is the same at every size;
    # the small side is hashed, so that texts need no sort
    found = raw.join(owners.hint("shuffle_hash"), "place").select("place", "keys", _norm(F.col("line")).alias("norm"))
    norm = F.col("norm")
    halves_kept = F.filter(_halves(norm), lambda h: F.array_contains("keys", h["key"]))
    candidates = written(found.select("place", "norm", halves_kept.alias("halves")), "lines")
    sent = candidates.mapInArrow(_neighbourhood, _SENT_DDL)
    pairs = written(sent.repartition("v").sortWithinPartitions("v").mapInArrow(_meet, "late bigint, early bigint"), "pairs").distinct()
    late = candidates.select(F.col("place").alias("late"), norm.alias("late_norm"))
    early = candidates.select(F.col("place").alias("early"), norm.alias("early_norm"))
    verified = pairs.join(late, "late").join(early, "early").filter(F.levenshtein("late_norm", "early_norm", 1) >= 0)
    return verified.groupBy("late").agg(F.min("early").alias("near"))


_KEYS = [f"key{i}" for i in range(4)]


def _doomed(places: Places, min_fuzzy_chars: int) -> DataFrame:
    """``place`` of every line that has an earlier duplicate."""
    lines = places.lines()
    fuzzy = F.length("norm") >= min_fuzzy_chars
    keyed = lines.select("place", *_LINE, *[F.when(fuzzy, key).alias(k) for k, key in zip(_KEYS, _half_keys(F.col("norm")))])
    # numbers only: lines are made distinct by a hash aggregation, combined map-side
    distinct = keyed.groupBy(*_LINE).agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("n"), *[F.min(k).alias(k) for k in _KEYS])
    distinct = written(distinct, "distinct-lines")
    near = _near(places.raw(), distinct)
    marked = distinct.select(*_LINE, "place", "n").join(near, F.col("place") == F.col("late"), "left")
    bad = written(marked.filter("n > 1 OR near IS NOT NULL").select(*_LINE, F.coalesce("near", "place").alias("earliest")), "bad-lines")
    return lines.select("place", *_LINE).join(bad, _LINE).filter("earliest < place").select("place")


def duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy_chars: int = MIN_FUZZY_CHARS) -> DataFrame:
    """``id, pos`` of every line that has an earlier duplicate."""
    ensure_importable(df.sparkSession)
    places = Places(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "text")
    gone = _doomed(places, min_fuzzy_chars).select(places.row_of(F.col("place")).alias("at"), places.line_of(F.col("place")).alias("pos"))
    return gone.join(places.table.select(places.code.alias("at"), "id"), "at").select("id", "pos")


def remove_duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy_chars: int = MIN_FUZZY_CHARS) -> DataFrame:
    """``df`` with the text cleaned, plus ``n_lines`` (not blank, before) and ``n_dropped``."""
    ensure_importable(df.sparkSession)
    places = Places(df.drop("n_lines", "n_dropped"), id_col, text_col)
    at, gone = fresh(places.table, "_at", "_gone")
    doomed = _doomed(places, min_fuzzy_chars)
    # one document's lines
    dropped = doomed.groupBy(places.row_of(F.col("place")).alias(at)).agg(F.collect_list(places.line_of(F.col("place"))).alias(gone))
    joined = places.table.join(dropped.hint("shuffle_hash"), places.code == F.col(at), "left")
    lines, text = places.split(), F.col(f"`{text_col}`")
    filled = F.filter(lines, lambda x: F.trim(x, F.lit(_BLANKS)) != "")
    counted = joined.withColumns({"n_lines": F.coalesce(F.size(filled), F.lit(0)).cast("long"), "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long")})
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    # lines are bound to a variable, so that the text is split once
    cleaned = F.transform(F.array(lines), lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n"))[0]
    return counted.withColumn(text_col, F.when(F.col(gone).isNull(), text).otherwise(cleaned)).select(*places.columns, "n_lines", "n_dropped")
