"""Secret scanning with inferred format automata.

Fixed patterns find labelled credentials (assignments, access keys, hex digests).  From a
bounded sample of each kind a prefix-tree acceptor is built whose states are merged while
their counts are statistically compatible (Hoeffding bound), which leaves a small
probabilistic automaton of the format.  Every other run of 8 and more credential
characters, of whatever length and with or without digits, is then scored by its likelihood
a character under each automaton against a character model of ordinary runs; those that
read like a known format are reported as ``like_<kind>`` beside the spans of the patterns,
which are never changed.

Null texts are empty.  Spans count code points, ends are exclusive.  Without labelled
credentials nothing is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lithosense.llm.common import ensure_importable, texts

# Kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

MAX_TRAIN = 400  # labelled strings a kind is inferred from, those of smallest hash
MAX_TRAIN_CHARS = 128  # of longer ones the beginning is trained on; they are found and scored like all others


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str
    value: str


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping within a kind."""
    out = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        out += [Span(*m.span(), "assign", m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [Span(*m.span(), "access", m[0]) for m in _ACCESS.finditer(text)]
    out += [Span(*m.span(), "hex", m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind)))


def candidate_runs(text: str, found: list[Span]) -> Iterator[tuple[int, int, str]]:
    """Runs of 8 and more credential characters that touch no span found."""
    taken = iter(sorted((s.start, s.end) for s in found))
    span, reach = next(taken, None), 0
    for m in _RUN.finditer(text):
        while span and span[0] < m.end():
            reach, span = max(reach, span[1]), next(taken, None)
        if reach <= m.start():
            yield m.start(), m.end(), m[0]


class Automaton:
    """A probabilistic automaton: arcs with counts, and how often each state ends a string.

    Of strings over ``MAX_TRAIN_CHARS`` the beginning is learnt, without an end.
    """

    END = ""

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.arcs: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        for s in strings:
            state = 0
            for c in [*s, self.END] if len(s) <= MAX_TRAIN_CHARS else s[:MAX_TRAIN_CHARS]:
                self.count[state][c] = self.count[state].get(c, 0) + 1
                if c:
                    if c not in self.arcs[state]:
                        self.arcs[state][c] = len(self.arcs)
                        self.arcs.append({})
                        self.count.append({})
                    state = self.arcs[state][c]
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        symbols = len(ALPHABET) + 1
        self._logs = [{c: math.log((n + 0.02) / (total + 0.02 * symbols)) for c, n in each.items()} for each, total in zip(self.count, self.totals)]
        self._unseen = [math.log(0.02 / (total + 0.02 * symbols)) for total in self.totals]

    def _compatible(self, a: int, b: int) -> bool:
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            na, nb = sum(self.count[a].values()), sum(self.count[b].values())
            limit = self._bound * (1 / math.sqrt(na) + 1 / math.sqrt(nb)) if na and nb else 1
            if limit < 1:
                for c in self.count[a].keys() | self.count[b].keys():
                    if abs(self.count[a].get(c, 0) / na - self.count[b].get(c, 0) / nb) > limit:
                        return False
            pending += [(self.arcs[a][c], self.arcs[b][c]) for c in self.arcs[a].keys() & self.arcs[b].keys()]
        return True

    def _fold(self, keep: int, gone: int) -> None:
        """Add the tree below ``gone`` to the automaton at ``keep``."""
        pending = [(keep, gone)]
        while pending:
            keep, gone = pending.pop()
            for c, n in self.count[gone].items():
                self.count[keep][c] = self.count[keep].get(c, 0) + n
            for c, target in self.arcs[gone].items():
                if c in self.arcs[keep]:
                    pending.append((self.arcs[keep][c], target))
                else:
                    self.arcs[keep][c] = target

    def _merge_all(self) -> None:
        """Visit states from the root; merge each into the first kept state it agrees with, else keep it."""
        kept = [0]
        done = {0}
        while True:
            fringe = [(k, c, t) for k in kept for c, t in sorted(self.arcs[k].items()) if t not in done]
            if not fringe:
                break
            source, char, state = max(fringe, key=lambda x: (sum(self.count[x[2]].values()), -x[2]))
            home = next((k for k in kept if self._compatible(k, state)), None)
            if home is None:
                kept.append(state)
                done.add(state)
            else:
                self.arcs[source][char] = home
                self._fold(home, state)
        self.states = len(kept)
        names = {k: i for i, k in enumerate(kept)}
        self.arcs = [{c: names[t] for c, t in self.arcs[k].items()} for k in kept]
        self.count = [self.count[k] for k in kept]
        self.totals = [sum(c.values()) for c in self.count]

    def log_likelihood(self, s: str) -> float:
        """Natural log of the string's probability; unseen steps get a small share and restart at the root."""
        return self._walk([*s, self.END])

    def rate(self, s: str) -> float:
        """Log-likelihood a character, the end left out, so that strings of all lengths compare."""
        return self._walk(s) / len(s)

    def _walk(self, steps) -> float:
        state, total = 0, 0.0
        arcs, logs, unseen = self.arcs, self._logs, self._unseen
        for c in steps:
            total += logs[state].get(c, unseen[state])
            state = arcs[state].get(c, 0)
        return total


class FormatModel:
    """An automaton for each kind, and the model of ordinary runs."""

    def __init__(self, labelled: dict[str, list[str]], pairs: dict[str, int]):
        self.automata = {kind: Automaton(strings) for kind, strings in labelled.items() if strings}
        self.pairs = pairs
        self.firsts: dict[str, int] = {}
        for pair, n in pairs.items():
            self.firsts[pair[0]] = self.firsts.get(pair[0], 0) + n
        symbols = len(ALPHABET) + 1
        self._logs = {pair: math.log((n + 0.5) / (self.firsts[pair[0]] + 0.5 * symbols)) for pair, n in pairs.items()}
        self._unseen = {a: math.log(0.5 / (self.firsts.get(a, 0) + 0.5 * symbols)) for a in "^" + ALPHABET}
        self.floor = {kind: self._floor(kind, strings) for kind, strings in labelled.items() if strings}

    def _floor(self, kind: str, strings: list[str]) -> float:
        """Log-likelihood a character below which only a twentieth of the labelled strings fall."""
        each = sorted(self.automata[kind].rate(s[:MAX_TRAIN_CHARS]) for s in strings)
        return each[len(each) // 20]

    def ordinary(self, s: str) -> float:
        """Log-likelihood a character under the model of ordinary runs, the end left out."""
        logs, unseen = self._logs, self._unseen
        total, before = 0.0, "^"
        for c in s:
            step = logs.get(before + c)
            total += unseen[before] if step is None else step
            before = c
        return total / len(s)

    def judge(self, s: str) -> str | None:
        """The kind whose format the run follows best, if it follows one better than ordinary runs are followed."""
        best = None
        if not self.automata:
            return None
        ordinary = self.ordinary(s)
        for kind, automaton in self.automata.items():
            score = automaton.rate(s)
            if score >= self.floor[kind] and score > ordinary and (best is None or score > best[0]):
                best = (score, kind)
        return best and best[1]


def _labelled(df: DataFrame, text_col: str) -> DataFrame:
    """Every labelled credential, and how often each pair of neighbouring characters stands in ordinary runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, values, pairs = [], [], {}
            runs: Counter[str] = Counter()
            for _, rows in texts(batch, "text"):
                for text in rows:
                    found = base_spans(text)
                    for s in found:
                        kinds.append(s.kind)
                        values.append(s.value)
                    runs.update(value for _, _, value in candidate_runs(text, found))
                for value, n in runs.items():
                    for a, b in zip("^" + value, value + "$"):
                        pairs[a + b] = pairs.get(a + b, 0) + n
                runs.clear()
            counts = [1] * len(values) + list(pairs.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds + ["pair"] * len(pairs), pa.string()), pa.array(values + list(pairs), pa.string()), pa.array(counts, pa.int64())],
                names=["kind", "value", "n"],
            )

    return df.select(F.col(text_col).alias("text")).mapInArrow(run, "kind string, value string, n bigint")


def fit(df: DataFrame, text_col: str = "text", max_train: int = MAX_TRAIN) -> FormatModel:
    """Learn the formats from the labelled credentials of the whole table.

    Pairs of characters are counted over all rows (their number is bounded by the alphabet);
    of each kind the ``max_train`` distinct strings of smallest hash are trained on.
    """
    ensure_importable(df.sparkSession)
    rows = _labelled(df, text_col).groupBy("kind", "value").agg(F.sum("n").alias("n")).persist()
    try:
        pairs = {r["value"]: r["n"] for r in rows.filter("kind = 'pair'").select("value", "n").toLocalIterator()}
        labelled = {
            kind: sorted(
                r["value"]
                for r in rows.filter(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(max_train).select(F.substring("value", 1, MAX_TRAIN_CHARS + 1).alias("value")).collect()
            )
            for kind in KINDS
        }
    finally:
        rows.unpersist()
    return FormatModel(labelled, pairs)


def scan(df: DataFrame, model: FormatModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id and ``spans``: an array of (start, end, kind), by start, fixed kinds before inferred ones."""
    ensure_importable(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formats = shared.value
        known: dict[str, str | None] = {}
        for batch in batches:
            for start, rows in texts(batch, "text"):
                spans = []
                for text in rows:
                    found = base_spans(text)
                    more = []
                    for a, b, value in candidate_runs(text, found):
                        if value not in known:
                            if len(known) > 100_000:
                                known.clear()
                            known[value] = formats.judge(value)
                        if known[value]:
                            more.append((a, 3, b, f"like_{known[value]}"))
                    every = sorted([(s.start, KINDS.index(s.kind), s.end, s.kind) for s in found] + more)
                    spans.append([{"start": a, "end": b, "kind": k} for a, _, b, k in every])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(rows)), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<start: bigint, end: bigint, kind: string>>"
    )


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the fixed kinds' spans, and all spans as text."""

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return scanned.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
