"""Repair of conversations whose turns are blank, repeated, cut off or out of order.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Each row may be kept (0), given the
role user or assistant (3) or deleted (4; blank and repeated rows must be), and empty turns may be
inserted anywhere (3); a row that was cut off and stays costs 3 more.  Wanted is the cheapest
repair, and among those the one whose edits' initials (the audit) come first in ASCII order.

Where the grammar stands after a row is one of four states, so a conversation is a graph of layers
(rows) and states, whose edges are a row's edits with the insertions before them.  A depth-first
branch-and-bound search with an explicit stack runs through it: a suffix bound (what the remaining
layers cost at least from a state, audits left out) and the incumbent (cost, audit) cut branches,
and a table per node of the best prefix that came there drops every worse one.  Edges are tried in
ASCII order.  The search ends when the stack is empty, which proves the incumbent.

Long conversations are cut into blocks of ``BLOCK`` rows.  A block is solved for every pair of
states at its ends; blocks are then layers with few edges themselves, and ``BLOCK`` of them are
solved by the same search, until a conversation is one.  So no task holds a long conversation's
rows; the audit, one letter an edit, is the only thing of its length.  Rows are numbered by a sort
that spills, repeats are found by a count over hashes combined map-side, and the digest of a
repaired text, which has to be read in order, is taken from a stream of sorted rows.

Defined cases: rows of a conversation are ordered by turn (nulls first), role, text.  Null roles and
texts are one space.  A role that does not begin with s, u or a (an empty one too) cannot be kept.  A
null conversation id is a conversation of its own.  A conversation without rows has cost 0 and an
empty audit and text.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lithosense.llm.common import ensure_importable, written

BLOCK = 256
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, CUT_OFF_COST = 3, 4, 3, 3

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STATES = (BEGIN, SYSTEM, USER, ASSISTANT)
_NEXT = {(BEGIN, "s"): SYSTEM, (BEGIN, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}
# The one turn that can be made (by insertion or a new role) in each state.
_MADE = {BEGIN: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_WORD = r"[^\x20\x09-\x0D]"

Edge = tuple[int, int, int, str]  # from, to, cost, letters


def _inserted(state: int) -> Iterator[tuple[int, int, str]]:
    """States reached by inserting turns, with cost and letters; more than two lead nowhere new."""
    cost, letters = 0, ""
    for _ in range(3):
        yield state, cost, letters
        state, cost, letters = _MADE[state], cost + INSERT_COST, letters + INSERT


def _row_edges(code: str) -> list[Edge]:
    """Edges of one row.  Codes: ``x`` must go; ``s u a o`` by role; capital: cut off."""
    edges: dict[tuple[int, str], Edge] = {}
    extra = CUT_OFF_COST if code.isupper() else 0
    for start in STATES:
        for state, cost, letters in _inserted(start):
            options = [(state, DELETE_COST, DELETE)]
            if code != "x":
                options.append((_MADE[state], REROLE_COST + extra, REROLE))
                if (state, code.lower()) in _NEXT:
                    options.append((_NEXT[state, code.lower()], extra, KEEP))
            for to, price, letter in options:
                edges[start, letters + letter] = (start, to, cost + price, letters + letter)
    return sorted(edges.values(), key=lambda e: e[3])


ROW_EDGES = {code: _row_edges(code) for code in "xsuaoSUAO"}
# The end of a conversation: nothing but insertions, to a complete (or empty) conversation.
END_EDGES: list[Edge] = [(BEGIN, ASSISTANT, 0, ""), (ASSISTANT, ASSISTANT, 0, ""), (SYSTEM, ASSISTANT, 2 * INSERT_COST, "II"), (USER, ASSISTANT, INSERT_COST, "I")]


def search(layers: list[list[Edge]], entry: int, exit_: int) -> tuple[int, str] | None:
    """The cheapest way through ``layers`` from ``entry`` to ``exit_``: (cost, audit), least audit among equals."""
    n = len(layers)
    # suffix bounds: the least cost from a state in a layer to the exit, audits left out
    bound: list[dict[int, int]] = [{} for _ in range(n)] + [{exit_: 0}]
    for i in range(n - 1, -1, -1):
        for start, to, cost, _ in layers[i]:
            if to in bound[i + 1]:
                least = cost + bound[i + 1][to]
                if least < bound[i].get(start, least + 1):
                    bound[i][start] = least
    if entry not in bound[0]:
        return None
    incumbent: tuple[int, str] | None = None
    best: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]
    stack: list[tuple[int, int, int, str]] = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        lower = cost + bound[i][state]
        if incumbent and (lower > incumbent[0] or (lower == incumbent[0] and audit > incumbent[1])):
            continue
        known = best[i].get(state)
        if known and known <= (cost, audit):
            continue
        best[i][state] = (cost, audit)
        if i == n:
            if not incumbent or (cost, audit) < incumbent:
                incumbent = (cost, audit)
            continue
        # pushed in falling order, so the first to be tried is the cheapest bound, then the least letters
        follow = [(c + bound[i + 1][to], letters, to, c) for start, to, c, letters in layers[i] if start == state and to in bound[i + 1]]
        stack.extend((i + 1, to, cost + c, audit + letters) for _, letters, to, c in sorted(follow, reverse=True))
    return incumbent


def between(layers: list[list[Edge]]) -> list[Edge]:
    """The best way through ``layers`` for every pair of states at their ends."""
    return [(a, b, *found) for a in STATES for b in STATES if (found := search(layers, a, b))]


# -- faults ------------------------------------------------------------------


def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with rows dropped, emptied, stripped, repeated or given the role user, by hash."""
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    key = F.concat(space(conv_col), F.lit(":"), space(turn_col))
    rows = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_kind"),
    ).filter("_kind <> 0")
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, 2).otherwise(1)
    return rows.withColumns({"text": text, "role": role}).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select("conv_id", "turn", "role", "text")


def faults(rows: DataFrame) -> DataFrame:
    """Rows numbered within their conversation (``n`` from 0), with a ``code`` for the search and ``illegal``.

    ``code``: x for blank (``fault`` says which) and repeated rows, else s, u, a or o by the role's initial, capital
    where the text breaks off.  ``illegal``: whether the row may not follow the one before.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    initial = F.left("role", F.lit(1))
    numbered = rows.withColumns({"n": F.row_number().over(order).cast("long") - 1, "before": F.lag(initial).over(order)})
    pair = F.concat("before", initial)
    numbered = numbered.withColumns({
        "illegal": F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)), "k1": F.xxhash64("role", "text"), "k2": F.hash("text", "role"),
        "blank": ~F.col("text").rlike(_WORD), "cut": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
    }).drop("before")
    numbered = written(numbered, "turns")
    # equal role and text by 96 bits of hash; one row a key after the map side
    first = numbered.filter("NOT blank").groupBy(F.col("conv_id").alias("_c"), F.col("k1").alias("_1"), F.col("k2").alias("_2")).agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("c"))
    again = first.filter("c > 1").drop("c")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2"))
    joined = numbered.join(again, same, "left").withColumn("repeated", ~F.col("blank") & F.coalesce(F.col("n") > F.col("first"), F.lit(False)))
    fault = F.when(F.col("blank"), "blank").when(F.col("repeated"), "duplicate").when(F.col("cut"), "truncated")
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(letter)).otherwise(letter)
    return written(joined.select("conv_id", "n", "turn", "role", "text", "illegal", fault.alias("fault"), code.alias("code")), "faults")


# -- search over all conversations -------------------------------------------

_EDGES = "array<struct<a:int,b:int,cost:bigint,audit:string>>"


def _edges_type() -> pa.DataType:
    return pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _packed(edges: list[Edge]) -> list[dict]:
    return [{"a": a, "b": b, "cost": cost, "audit": audit} for a, b, cost, audit in edges]


def _solved(groups: DataFrame, layers_of, conv_type) -> DataFrame:
    """``conv_id, block, edges`` from one row a group; ``layers_of`` reads the group's layers in order."""
    arrow = to_arrow_type(conv_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                edges = [_packed(between(layers_of(x))) for x in part.column("layers").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("conv_id").cast(arrow), part.column("block"), pa.array(edges, _edges_type())], names=["conv_id", "block", "edges"])

    return groups.select("conv_id", "block", "layers").mapInArrow(run, f"conv_id {conv_type.simpleString()}, block bigint, edges {_EDGES}")


def _row_layers(codes: str) -> list[list[Edge]]:
    return [ROW_EDGES[c] for c in codes]


def _block_layers(blocks: list) -> list[list[Edge]]:
    return [sorted(((e["a"], e["b"], e["cost"], e["audit"]) for e in block), key=lambda e: e[3]) for block in blocks]


def repairs(coded: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, cost, audit`` of every conversation in ``coded`` (``conv_id, n, code``)."""
    ensure_importable(coded.sparkSession)
    kind = coded.schema["conv_id"].dataType
    up = lambda c: F.floor(F.col(c) / block).cast("long").alias("block")
    # at most ``block`` rows in an array, here and below
    codes = coded.groupBy("conv_id", up("n")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "code"))), lambda x: x["code"]), "").alias("layers"))
    solved = written(_solved(codes, _row_layers, kind), "blocks")
    last = solved.agg(F.max("block")).first()[0] or 0
    while last > 0:
        grouped = solved.groupBy("conv_id", up("block")).agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "edges"))), lambda x: x["edges"]).alias("layers"))
        solved = written(_solved(grouped, _block_layers, kind), "blocks")
        last //= block
    # the end of the conversation: from each state that can be reached, what is still to be inserted
    ends = F.map_from_arrays(F.array(*[F.lit(a) for a, *_ in END_EDGES]), F.array(*[F.struct(F.lit(cost).cast("long").alias("cost"), F.lit(letters).alias("letters")) for _, _, cost, letters in END_EDGES]))
    whole = F.transform(
        F.filter("edges", lambda e: e["a"] == BEGIN),
        lambda e: F.struct((e["cost"] + ends[e["b"]]["cost"]).alias("cost"), F.concat(e["audit"], ends[e["b"]]["letters"]).alias("audit")),
    )
    return solved.select("conv_id", F.array_min(whole).alias("best")).select("conv_id", "best.cost", "best.audit")


def _steps(found: DataFrame) -> DataFrame:
    """``conv_id, n, edits``: the letters that belong to row ``n``, insertions before it first; what follows the last row stands alone."""
    kind = found.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for conv, audit in zip(batch.column("conv_id").to_pylist(), batch.column("audit").to_pylist()):
                edits, letters = [], ""
                for c in audit:
                    letters += c
                    if c != INSERT:
                        edits.append(letters)
                        letters = ""
                edits += [letters] * bool(letters)
                for start in range(0, len(edits), 10_000):
                    part = edits[start : start + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array([conv] * len(part), arrow), pa.array(range(start, start + len(part)), pa.int64()), pa.array(part)], names=["conv_id", "n", "edits"])

    return found.select("conv_id", "audit").mapInArrow(run, f"conv_id {kind.simpleString()}, n bigint, edits string")


def repaired_turns(turns: DataFrame, found: DataFrame, digest: bool = False) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text`` a row, or with ``digest`` their ``repaired_sha256``.

    Rows and their edits are sorted into one stream by conversation and number; nothing of a
    conversation is held but the state of the grammar and of the hash.
    """
    kind = turns.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    none = F.lit(None).cast("string")
    edits = _steps(found).select("conv_id", "n", F.lit(0).alias("what"), "edits", none.alias("role"), none.alias("text"))
    both = turns.select("conv_id", "n", F.lit(1).alias("what"), none.alias("edits"), "role", "text").unionByName(edits)
    stream = both.repartition("conv_id").sortWithinPartitions("conv_id", "n", "what")

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(conversation, role, text) of every repaired turn; role None begins a conversation."""
        state, last, letter = BEGIN, object(), ""
        for batch in batches:
            for conv, what, letters, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "what", "edits", "role", "text"))):
                if conv != last:
                    state, last = BEGIN, conv
                    yield conv, None, None
                if what == 0:
                    for c in letters:
                        if c == INSERT:
                            state = _MADE[state]
                            yield conv, _NAME[state], ""
                    letter = letters[-1]
                elif letter == KEEP:
                    state = _NEXT[state, role[:1]]
                    yield conv, role, text
                elif letter == REROLE:
                    state = _MADE[state]
                    yield conv, _NAME[state], text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, places, roles, texts = [], [], [], []
        place = 0
        for conv, role, text in repaired(batches):
            if role is None:
                place = 0
                continue
            for column, value in zip((convs, places, roles, texts), (conv, place, role, text)):
                column.append(value)
            place += 1
            if len(convs) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(convs, arrow), pa.array(places, pa.int64()), pa.array(roles), pa.array(texts)], names=["conv_id", "place", "role", "text"])
                convs, places, roles, texts = [], [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(convs, arrow), pa.array(places, pa.int64()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], names=["conv_id", "place", "role", "text"])

    def run_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convs, shas = [], []
        sha, first = None, True

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(convs, arrow), pa.array(shas, pa.string())], names=["conv_id", "repaired_sha256"])

        for conv, role, text in repaired(batches):
            if role is None:
                if sha:
                    shas.append(sha.hexdigest())
                convs.append(conv)
                sha, first = hashlib.sha256(), True
                if len(shas) == 10_000:
                    convs, head = [], convs[:-1]
                    yield pa.RecordBatch.from_arrays([pa.array(head, arrow), pa.array(shas)], names=["conv_id", "repaired_sha256"])
                    convs, shas = [conv], []
                continue
            sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
        if sha:
            shas.append(sha.hexdigest())
        yield batch()

    rows = stream.select("conv_id", "what", "edits", "role", "text")
    if digest:
        return rows.mapInArrow(run_digest, f"conv_id {kind.simpleString()}, repaired_sha256 string")
    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, place bigint, role string, text string")


def digests(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per conversation: its faults, the cheapest repair's cost and audit, and the digest of the repaired turns.

    ``conversations`` holds the ids to report (``conv_id``, each once); ``rows`` has ``conv_id, turn, role, text``.
    """
    turns = faults(rows)
    # turns of a conversation are made distinct before they are counted
    span = turns.filter("turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("one")).cast("long").alias("gaps")
    )
    counts = turns.groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == name).cast("long").alias(name) for name in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").cast("long").alias("illegal"),
    )
    found = written(repairs(turns.select("conv_id", "n", "code"), block), "repairs")
    shas = repaired_turns(turns, found, digest=True)
    out = conversations.select("conv_id")
    for part in (span, counts, found, shas):
        part = part.withColumnRenamed("conv_id", "_c")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
