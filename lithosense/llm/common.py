"""What the operators of this subpackage share: table access, imports on executors, batches."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lithosense.session import materialise

_ROOT = Path(__file__).resolve().parents[2]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``df`` does not have (columns are compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ensure_importable(spark: SparkSession) -> None:
    """Give the Python workers this package, unless they find it by themselves.

    With ``PYTHONPATH`` set or jobs started in the repository they do; otherwise the
    package is sent once per application, as ``spark-submit --py-files`` would.
    """
    roots = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if any(r and Path(r).resolve() == _ROOT for r in roots):
        return
    context = spark.sparkContext
    name = f"lithosense-{context.applicationId}.zip"
    if any(path.endswith(name) for path in context.listFiles):
        return
    target = Path(tempfile.mkdtemp()) / name
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted((_ROOT / "lithosense").rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT))
    context.addPyFile(str(target))


def texts(batch: pa.RecordBatch, column: str, step: int = 512) -> Iterator[tuple[int, list[str]]]:
    """Slices of a text column as Python strings, null as the empty text, with the row they start at."""
    values = batch.column(column)
    for start in range(0, len(values), step):
        yield start, ["" if v is None else v for v in values.slice(start, step).to_pylist()]


_kept: dict = {}


def kept(key, make):
    """What a worker process keeps between tasks: one thing, the last one asked for."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Drop what an earlier operator's tasks left in this worker process."""
    _kept.clear()


def input_bytes(df: DataFrame, text_col: str) -> int:
    """Total UTF-8 length of a text column; sizes partitions, never chooses a method."""
    from pyspark.sql import functions as F

    return df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0


def partitions_for(total: int, each: int) -> int:
    return max(1, -(-total // each))


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by a table in the shared folder; the shuffle files behind it are removed at once."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN_UP, "false")
    spark.conf.set(_CLEAN_UP, "true")
    try:
        return materialise(df, label)
    finally:
        spark.conf.set(_CLEAN_UP, before)
