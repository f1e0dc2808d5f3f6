"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from pagequarry.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = 8 << 20, weight: Callable[[tuple], int] | None = None):
    """Arrow batches of at most 10,000 rows or about ``limit`` bytes of ``weight``."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weight(row) if weight else 0
        if len(held) >= 10_000 or size >= limit:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_HELD: dict = {}


def held_by_worker(kind: str, token: object, make: Callable[[], object]):
    """What ``make`` builds, kept in this Python worker for later tasks of the
    same kind and token; what another operator kept there is let go."""
    if _HELD.get("kind") != kind or _HELD.get("token") is not token:
        _HELD.clear()
        _HELD.update(kind=kind, token=token, value=make())
    return _HELD["value"]


def release_worker() -> None:
    """Let go of what operators before kept in this Python worker."""
    _HELD.clear()


def small_batches(stream: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def staged(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to a new folder in the shared place and read
    back, and that folder, which ``drop_scratch`` deletes. ``options`` are the writer's.

    Cuts the lineage: a lost executor costs a read of these files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    """As :func:`staged`, for a table that stays."""
    return staged(df, name)[0]


def shared_files(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def write_file(files: fs.FileSystem, path: str, chunks: Iterator[bytes]) -> int:
    """Write under a name of this attempt, then rename: a second attempt of a
    task puts the same bytes in the same place and leaves no half file."""
    attempt = f"{path}.{uuid.uuid4().hex}"
    size = 0
    with files.open_output_stream(attempt) as out:
        for chunk in chunks:
            size += out.write(chunk)
    files.move(attempt, path)
    return size
