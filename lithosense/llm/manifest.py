"""A Merkle manifest of a dataset, its upper proofs exchanged as in a butterfly.

A row's leaf is the SHA-256 of its fields.  Within a source leaves are ordered; every ``fanout``
consecutive nodes become the hash of their hex digests until one is left, the source's subroot;
the subroots, ordered by source, become the root in the same way.

Leaves are numbered by a range sort and cut into aligned blocks of ``fanout ** levels``.  A block
hashes its own subtree.  Then blocks swap: in a round, up to ``fanout`` neighbouring subtrees of
equal size form a group, and each block of a subtree meets one block of every other.  All that
meet get the group's roots, append them to their proof and hash the same ancestor, redundantly.
So after as many rounds as the tree has levels every block knows its whole upper proof, and
nothing is handed down.  Where the last subtree has fewer blocks, these serve more partners.  The
rounds run within all sources at once, then among sources.

No task holds more than one block of leaves or ``fanout`` roots, so a source with most rows is
many blocks, not a hot key.  The tables exchanged hold one row a block, and are written each round.

Defined cases: a null field is ``-``, so null and empty differ.  Rows of one source with the same
id are ordered by leaf; null ids and sources come first.  Repeated rows are leaves of their own.
A lone leaf is its subroot, a lone subroot the root.  An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lithosense.llm.common import ensure_importable, written

FANOUT, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(fields: list[Column]) -> Column:
    """Each field as its UTF-8 byte count, ``:`` and value, or ``-`` if null; hashed together."""

    def packed(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[packed(c) for c in fields]).cast("binary"), 256)


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``s`` (place of the source), ``pos`` (place within it), ``n`` (leaves of it) and ``n_sources``."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf"]
    ordered = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written(ordered.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "leaves")
    # one row a source and range
    pieces = written(ordered.groupBy("source", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("c")), "pieces")
    in_source = Window.partitionBy("source").orderBy("part")
    before = F.coalesce(F.sum("c").over(in_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select("source", "part", "first", before.alias("before"), F.sum("c").over(Window.partitionBy("source")).alias("n"))
    # a source's place: sources that begin in earlier ranges, then those that begin before it in its own
    begin = placed.filter("before = 0").select("source", "part", "first")
    per_part = begin.groupBy("part").agg(F.count(F.lit(1)).alias("starts"))
    earlier = per_part.select("part", F.coalesce(F.sum("starts").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    index = begin.select("source", "part", within.alias("within")).join(earlier, "part").select(F.col("source").alias("x"), (F.col("earlier") + F.col("within")).alias("s"))
    known = placed.join(index, F.col("source").eqNullSafe(F.col("x"))).select(F.col("source").alias("x"), F.col("part").alias("y"), "first", "before", "n", "s")
    known = written(known.withColumn("n_sources", index.agg(F.count(F.lit(1))).scalar()), "sources")
    joined = ordered.join(known, F.col("source").eqNullSafe(F.col("x")) & (F.col("part") == F.col("y")))
    return joined.withColumn("pos", F.col("before") + F.col("seq") - F.col("first")).drop("x", "y", "first", "before", "part", "seq")


def subtree(leaves: list[str], fanout: int, levels: int, alone: bool) -> list[list[str]]:
    """The nodes of each level of one block, leaves first; a block that is ``alone`` stops at one node."""
    rows = [leaves]
    while len(rows[-1]) > 1 or (not alone and len(rows) <= levels):
        rows.append([digest(rows[-1][i : i + fanout]) for i in range(0, len(rows[-1]), fanout)])
    return rows


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[list[dict]]:
    """Consecutive rows with the same key, across batches."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if run and any(run[0][k] != row[k] for k in key):
                yield run
                run = []
            run.append(row)
    if run:
        yield run


def _block_roots(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """One row a block: ``s, p, trees`` (blocks of the source), ``n_sources, root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [(r[0]["s"], r[0]["p"], r[0]["trees"], r[0]["n_sources"], subtree([x["leaf"] for x in r], fanout, levels, r[0]["trees"] == 1)[-1][0]) for r in _runs(batches, ("s", "p"))]
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)], names=["s", "p", "trees", "n_sources", "root"])

    return blocks.select("s", "p", "trees", "n_sources", "leaf").mapInArrow(run, "s bigint, p bigint, trees bigint, n_sources bigint, root string")


def _swap(members: DataFrame, fanout: int) -> DataFrame:
    """One round of the butterfly within every ``scope`` that still has several subtrees.

    Members are ``scope, trees, t`` (subtree), ``l`` (place in it), ``root`` and the proof so
    far; all members of a subtree have its root.  Member ``l`` of a subtree of ``m`` meets
    those at ``l``, ``l + m``, ``l + 2m``, … of the others, up to the widest of the group.
    """
    done, busy = members.filter("trees = 1"), members.filter("trees > 1")
    group = F.floor(F.col("t") / fanout).cast("long")
    sizes = busy.groupBy("scope", "t").agg(F.count(F.lit(1)).alias("m"))
    sizes = sizes.withColumn("widest", F.max("m").over(Window.partitionBy("scope", group)))
    carried = [c for c in members.columns if c not in ("scope", "trees", "t", "l", "root")]
    sent = busy.join(sizes, ["scope", "t"]).withColumn("low", F.explode(F.sequence("l", F.col("widest") - 1, "m")))
    own = F.col("low") == F.col("l")
    # a group holds at most ``fanout`` rows; the proof travels only with a member's own row
    message = F.struct(
        (F.col("t") % fanout).cast("int").alias("at"), "root", "m", own.alias("own"), "trees",
        *[F.when(own, F.col(c)).alias(c) for c in carried],
    )
    met = sent.groupBy("scope", group.alias("g"), "low").agg(F.sort_array(F.collect_list(F.struct(message["at"].alias("at"), message.alias("v")))).alias("met"))
    run = F.transform("met", lambda x: x["v"]["root"])
    shift = lambda v: F.aggregate(F.filter("met", lambda x: x["at"] < v["at"]), F.lit(0).cast("long"), lambda n, x: n + x["v"]["m"])
    each = met.withColumn("run", run).withColumn("v", F.explode(F.filter("met", lambda x: x["v"]["own"]))).withColumn("v", F.col("v.v"))
    level = F.array(F.struct(F.col("v.at").alias("at"), F.col("run").alias("nodes")))
    raised = each.select(
        "scope", F.ceil(F.col("v.trees") / fanout).cast("long").alias("trees"), F.col("g").alias("t"), (F.col("low") + shift(F.col("v"))).alias("l"),
        F.sha2(F.array_join("run", "").cast("binary"), 256).alias("root"),
        *[(F.concat("v.upper", level) if c == "upper" else F.col(f"v.{c}")).alias(c) for c in carried],
    )
    return done.select(*members.columns).unionByName(raised.select(*members.columns))


def _exchanged(members: DataFrame, fanout: int) -> DataFrame:
    most = members.agg(F.max("trees")).first()[0] or 1
    while most > 1:
        members = written(_swap(members, fanout), "butterfly")
        most = -(-most // fanout)
    return members


def upper_proofs(roots: DataFrame, fanout: int) -> DataFrame:
    """``s, p, subroot, root, upper``: for each block the runs above it, lowest first, with its place in them."""
    none = F.array().cast("array<struct<at:int,nodes:array<string>>>")
    start = roots.select(F.col("s").alias("scope"), "trees", F.col("p").alias("t"), F.lit(0).cast("long").alias("l"), "root", "s", "p", "n_sources", F.lit("").alias("subroot"), none.alias("upper"))
    inside = _exchanged(written(start, "block-roots"), fanout)
    # the same among sources: a source is a subtree, its blocks are the members
    among = inside.withColumns({"scope": F.lit(0).cast("long"), "trees": F.col("n_sources"), "t": F.col("s"), "l": F.col("p"), "subroot": F.col("root")})
    return _exchanged(among, fanout).select("s", "p", "subroot", "root", "upper")


def fold(leaf: str, proof: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its proof (place and run of each level) give."""
    node = leaf
    for at, nodes in proof:
        node = digest([*nodes[:at], node, *nodes[at + 1 :]])
    return node


_LEVEL = pa.struct([("at", pa.int32()), ("nodes", pa.list_(pa.string()))])


def manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, proofs: bool = False) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaves`` has ``doc_id, source, leaf`` and ``claimed``, the leaf that somebody presents
    (null: the same); it is folded with the proof of ``leaf`` and held against the root.
    With ``proofs`` the proof itself comes too: for each level the run and the place in it.
    """
    ensure_importable(leaves.sparkSession)
    id_type = leaves.schema["doc_id"].dataType
    block = fanout**levels
    numbered = _numbered(written(leaves.select("doc_id", "source", "leaf", "claimed"), "hashed"))
    placed = numbered.select(
        "s", F.floor(F.col("pos") / block).cast("long").alias("p"), "pos", F.ceil(F.col("n") / block).cast("long").alias("trees"), "n_sources", "doc_id", "leaf", "claimed"
    )
    blocks = written(placed.repartition("s", "p").sortWithinPartitions("s", "p", "pos"), "blocks")
    upper = upper_proofs(_block_roots(blocks.repartition("s", "p").sortWithinPartitions("s", "p", "pos"), fanout, levels), fanout)
    # a block's proof sorts before its leaves
    empty = {c: F.lit(None) for c in ("subroot", "root", "upper")}
    both = blocks.drop("n_sources").withColumns(empty).unionByName(upper.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    both = both.repartition("s", "p").sortWithinPartitions("s", "p", "pos")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] + ["proof"] * proofs
    kinds = [to_arrow_type(id_type), *[pa.string()] * 5, pa.bool_(), pa.list_(_LEVEL)][: len(names)]
    hexes = ", ".join(f"{c} string" for c in names[1:6])
    ddl = f"doc_id {id_type.simpleString()}, {hexes}, verified boolean" + ", proof array<struct<at:int,nodes:array<string>>>" * proofs

    def one(head: dict, rows: list[dict]) -> Iterator[tuple]:
        tree = subtree([r["leaf"] for r in rows], fanout, levels, rows[0]["trees"] == 1)
        above = [(x["at"], x["nodes"]) for x in head["upper"]]
        siblings_above = "".join(n for at, nodes in above for i, n in enumerate(nodes) if i != at)
        for i, row in enumerate(rows):
            proof = []
            for nodes in tree[:-1]:
                start = i - i % fanout
                proof.append((i % fanout, nodes[start : start + fanout]))
                i //= fanout
            below = "".join(n for at, nodes in proof for k, n in enumerate(nodes) if k != at)
            folded = fold(row["claimed"] or row["leaf"], proof + above)
            whole = [{"at": at, "nodes": nodes} for at, nodes in proof + above]
            yield (row["doc_id"], row["leaf"], head["subroot"], head["root"], digest([below, siblings_above]), folded, folded == head["root"], whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("s", "p")):
            out = list(one(rows[0], rows[1:]))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

    return both.select("s", "p", "pos", "trees", "doc_id", "leaf", "claimed", "subroot", "root", "upper").mapInArrow(run, ddl)


def tampered(text: Column, id_: Column) -> Column:
    """A text with its A-Z lowered where 5 divides the CRC-32 of the decimal id; all others as they are."""
    upper = "".join(map(chr, range(65, 91)))
    hit = F.crc32(id_.cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(text, upper, upper.lower())).otherwise(text)


def leaves(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: tuple[str, ...] = FIELDS, presented: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, source, leaf, claimed``; ``presented`` replaces fields in the copy that is checked."""
    col = lambda c: F.col(f"`{c}`")
    original = [col(c) for c in fields]
    claimed = leaf_of([(presented or {}).get(c, col(c)) for c in fields]) if presented else F.lit(None).cast("string")
    return df.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), leaf_of(original).alias("leaf"), claimed.alias("claimed"))
