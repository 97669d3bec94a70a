"""Consistent placement by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by its own permutation (offset and
step drawn from its name).  Shards take turns; each claims the first slot of its order
that is still free, until the table is full.  Shares then differ by one slot at most, and
a shard that joins or leaves moves few keys besides its own.  The table is small and of a
size fixed by the caller, so it is broadcast and placing a row is one look-up.

The key is the text of the key columns.  Null keys count as the empty text, so every row
has a shard; rows with equal keys share one.  To spread a hot key give further columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1 << 21


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _draw(name: str, salt: str, below: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big") % below


def fill_table(shards: list[str], size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> np.ndarray:
    """The index of the owning shard for every slot.

    A shard of weight ``w`` (1 unless given) claims ``w`` slots in its turn.
    """
    if not is_prime(size) or size > MAX_TABLE_SIZE:
        raise ValueError(f"the table size must be a prime of at most {MAX_TABLE_SIZE}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    turns = [max(1, int((weights or {}).get(s, 1))) for s in shards]
    at = [_draw(s, "offset", size) for s in shards]
    step = [1 + _draw(s, "step", size - 1) for s in shards]
    owner = np.full(size, -1, np.int32)
    free = size
    while free:
        for i, claims in enumerate(turns):
            for _ in range(min(claims, free)):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + step[i]) % size
                owner[at[i]] = i
                free -= 1
    return owner


def slot(*key_cols: str, size: int = TABLE_SIZE):
    """Slot of a row: the first 60 bits of the key's MD5, modulo the table size."""
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key_cols])
    return (F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long") % size).cast("int")


def assign(df: DataFrame, shards: list[str], key_cols: tuple[str, ...] = ("doc_id",), size: int = TABLE_SIZE, weights: dict[str, int] | None = None) -> DataFrame:
    """``df`` plus ``slot`` and ``shard`` (columns of these names are replaced)."""
    owner = fill_table(shards, size, weights)
    spark = df.sparkSession
    lookup = spark.createDataFrame(
        pd.DataFrame({"slot": np.arange(size, dtype=np.int32), "shard": np.array(shards, dtype=object)[owner]}), "slot int, shard string"
    )
    kept = [c for c in df.columns if c not in ("slot", "shard")]
    placed = df.select(*[F.col(f"`{c}`") for c in kept if c not in key_cols], *[F.col(f"`{c}`") for c in kept if c in key_cols], slot(*key_cols, size=size).alias("slot"))
    # at most MAX_TABLE_SIZE rows, whatever the data
    return placed.join(F.broadcast(lookup), "slot").select(*[f"`{c}`" for c in kept], "slot", "shard")


def write_sharded(df: DataFrame, path: str, shards: list[str], **options) -> None:
    """One folder per shard; a shard of many rows is split over several tasks and files."""
    assign(df, shards, **options).hint("rebalance", "shard").write.mode("overwrite").partitionBy("shard").parquet(path)
