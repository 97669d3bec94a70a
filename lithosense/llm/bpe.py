"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one valid tokenisation, hence one *last token*.  The
encoder stores that token for each prefix: token ``t`` ends prefix ``i`` exactly if the
last token of the prefix before ``t`` may stand beside ``t``, that is, if no merge across
their border would have come before the merges that built them.  Reading the stored
tokens backwards gives the encoding.  The table makes appends exact (only new prefixes
are filled in) and an edit local (filling stops once the entries agree again).

Results equal tiktoken's ``encode_ordinary``.  Null texts are empty; an empty text has no
tokens.  Ties, repeated rows and texts of any length need no special care.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lithosense.llm.common import ensure_importable, release, texts

MAX_VOCABULARY_BYTES = 64 << 20
CACHED_PIECES = 400_000
CACHED_PREFIXES = 400_000
SHORT_BYTES = 64  # pieces up to this length are kept, and so are the entries of their prefixes
_SAFE_RANGES = ((0x0, 0x250), (0x2010, 0x2028), (0x20A0, 0x20AD))


class Vocabulary:
    """Token bytes by rank, and which tokens may follow each other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=0)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._right: dict[int, list[tuple[bytes, int]]] = {}
        self._left: dict[int, list[tuple[bytes, int]]] = {}
        self._beside: dict[tuple[int, int], bool] = {}
        self._last: dict[bytes, int] = {}

    @classmethod
    def parse(cls, raw: bytes) -> Vocabulary:
        """From the text form of a rank file: base64 token, space, rank."""
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if merging never makes it."""
        if token not in self._halves:
            parts = [bytes([b]) for b in self.tokens[token]]
            while len(parts) > 2:
                options = [(self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(options)
                if rank >= token:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[token]

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """Tokens that stand at one edge while ``token`` is built, each with the rank that consumes it."""
        edge, consumed = [], len(self.tokens) + 1
        while True:
            edge.append((self.tokens[token], consumed))
            if len(self.tokens[token]) == 1:
                return edge
            consumed, token = token, self.halves(token)[side]

    def beside(self, left: int, right: int) -> bool:
        """Whether encoding the bytes of both tokens together gives the two again.

        Equal ranks merge from left to right, so a merge across the border loses a tie
        against one inside ``left`` and wins it against one inside ``right``.
        """
        known = self._beside.get((left, right))
        if known is None:
            ends = self._right.get(left)
            if ends is None:
                ends = self._right[left] = self._edge(left, 1)
            starts = self._left.get(right)
            if starts is None:
                starts = self._left[right] = self._edge(right, 0)
            known = self._apart(ends, starts)
            if len(self._beside) > 2_000_000:
                self._beside.clear()
            self._beside[left, right] = known
        return known

    def _apart(self, ends: list[tuple[bytes, int]], starts: list[tuple[bytes, int]]) -> bool:
        """Whether no merge of an edge on the left with one on the right comes before both are consumed."""
        rank_of = self.ranks.get
        for a, before_a in ends:
            for b, before_b in starts:
                merged = rank_of(a + b)
                if merged is not None and merged < before_a and merged <= before_b:
                    return False
        return True

    def last(self, data: bytes) -> int:
        """The last token of a short string: the prefix table's last entry, from only those entries it takes.

        Words begin alike, so entries are kept by their prefix and serve the next string too.
        """
        known = self._last.get(data)
        if known is None:
            known = self._find_last(data)
            if len(self._last) >= CACHED_PREFIXES:
                self._last.clear()
            self._last[data] = known
        return known

    def _find_last(self, data: bytes) -> int:
        rank_of = self.ranks.get
        token = rank_of(data)
        if token is not None and self.reachable(token):
            return token
        for start in range(max(1, len(data) - self.longest), len(data)):
            token = rank_of(data[start:])
            if token is not None and self.reachable(token) and self.beside(self.last(data[:start]), token):
                return token
        raise ValueError("a byte is missing from the vocabulary")

    def short_ids(self, data: bytes) -> list[int]:
        """The ids of a string that is short enough for a call per byte."""
        out = []
        while data:
            token = self.last(data)
            out.append(token)
            data = data[: -len(self.tokens[token])]
        return out[::-1]


class PrefixTable:
    """A byte string with the last token of each of its prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _entry(self, end: int) -> int:
        v, data, last = self.vocabulary, self.data, self.last
        for start in range(max(0, end - v.longest), end):
            token = v.ranks.get(data[start:end])
            if token is not None and v.reachable(token) and (start == 0 or v.beside(last[start], token)):
                return token
        raise ValueError("a byte is missing from the vocabulary")

    def append(self, more: bytes) -> None:
        """Extend the string; entries of old prefixes stay."""
        end = len(self.data)
        self.data += more
        for i in range(end + 1, len(self.data) + 1):
            self.last.append(self._entry(i))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were computed anew.

        An entry depends on the ``longest`` bytes and entries before it only, so after that
        many equal ones in a row all later ones are equal too.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[: start + 1]
        same = computed = 0
        for i in range(start + 1, len(self.data) + 1):
            entry = self._entry(i)
            computed += 1
            self.last.append(entry)
            beyond = i - (start + len(new))
            same = same + 1 if beyond > 0 and old[i - shift] == entry else 0
            if same >= self.vocabulary.longest:
                self.last.extend(old[i - shift + 1 :])
                break
        return computed

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[self.last[end]])
        return out[::-1]


class _Pieces(dict):
    """Packed ids of pieces met before."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        if whole is not None:
            ids = [whole]
        elif len(data) <= SHORT_BYTES:
            ids = self.vocabulary.short_ids(data)
        else:
            ids = PrefixTable(self.vocabulary, data).ids()
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(data) <= SHORT_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Splits texts by a pattern, encodes each piece, decodes ids."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.pieces = _Pieces(vocabulary)
        self.split = regex.compile(pattern)
        self.plain, self.rare = _plain_pattern(pattern)

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        plain = self.plain is not None and self.rare.search(text) is None
        found = (self.plain if plain else self.split).findall(text)
        return b"".join(map(self.pieces.__getitem__, found))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _plain_pattern(pattern: str) -> tuple[re.Pattern | None, re.Pattern | None]:
    """The pattern with its Unicode classes written out for common characters, and what is not common.

    The standard library's matcher is several times faster but lacks the classes.  A text
    with any character outside the ranges is split by the pattern as given.
    """
    chars = [chr(c) for low, high in _SAFE_RANGES for c in range(low, high)]
    member = {name: "".join(re.escape(c) for c in chars if regex.match(cls, c)) for name, cls in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s"))}
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{member['s']}{member['L']}{member['N']}]")
    for cls, name in ((r"\p{L}", "L"), (r"\p{N}", "N"), (r"\S", None), (r"\s", "s")):
        inside = inside.replace(cls, f"[{member[name]}]" if name else f"[^{member['s']}]")
    rare = "".join(f"{re.escape(chr(low))}-{re.escape(chr(high - 1))}" for low, high in _SAFE_RANGES)
    return (None, None) if r"\p" in inside else (re.compile(inside), re.compile(f"[^{rare}]"))


@lru_cache(maxsize=2)
def _codec(raw: bytes, pattern: str) -> Codec:
    """One per worker process, so pieces met in one task serve the next."""
    return Codec(Vocabulary.parse(raw), pattern)


def _shared(df: DataFrame, ranks_path: str):
    """The rank file, read by the driver and sent once to every executor; its size is checked."""
    ensure_importable(df.sparkSession)
    with open(ranks_path, "rb") as file:
        raw = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError("the rank file is larger than a vocabulary may be")
    return df.sparkSession.sparkContext.broadcast(raw)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", into: str = "token_ids", digests: bool = False) -> DataFrame:
    """All columns of ``df`` plus the ids of each text, as an array of integers in column ``into``.

    With ``digests`` also ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned
    32-bit integers) and ``decoded_sha256`` (of the decoded bytes).  Columns of these names
    are replaced.  ``into=None`` leaves the ids out.
    """
    added = ([(into, "array<int>")] if into else []) + ([("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")] if digests else [])
    kept = [f for f in df.schema.fields if f.name not in {name for name, _ in added}]
    if text_col not in [f.name for f in kept]:
        raise ValueError("the text column may not be replaced")
    shared = _shared(df, ranks_path)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        codec = _codec(shared.value, pattern)
        for batch in batches:
            for start, rows in texts(batch, text_col):
                packed = [codec.packed(t) for t in rows]
                columns = [batch.column(n).slice(start, len(rows)) for n in names]
                if into:
                    flat = pa.array(np.frombuffer(b"".join(packed), "<u4").view("<i4"))
                    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
                if digests:
                    columns.append(pa.array([len(p) // 4 for p in packed], pa.int64()))
                    columns.append(pa.array([hashlib.sha256(p).hexdigest() for p in packed]))
                    columns.append(pa.array([hashlib.sha256(codec.decode(p)).hexdigest() for p in packed]))
                yield pa.RecordBatch.from_arrays(columns, names=names + [n for n, _ in added])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {t}" for n, t in added])
    return df.select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "token_ids", into: str = "decoded") -> DataFrame:
    """All columns of ``df`` plus the decoded bytes (null ids: null)."""
    shared = _shared(df, ranks_path)
    names = [n for n in df.columns if n != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, "")
        for batch in batches:
            out = [None if ids is None else b"".join(codec.vocabulary.tokens[i] for i in ids) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.binary())], names=[*names, into])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != into] + [f"`{into}` binary"])
    return df.select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)
