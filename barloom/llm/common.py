"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import checkpoint_dir

#: Rows per Arrow batch handed to a Python task: whole texts may be very long,
#: so a batch is bounded by few rows (each operator also slices it by words).
ARROW_ROWS = 512

#: White space of the word rule ``[^\x20\x09-\x0D]+``: exactly what
#: ``bytes.split()`` splits at.
SPACE_CHARS = " \t\n\x0b\x0c\r"


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of one Arrow batch (never raises a smaller setting)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def sliced(run: Callable, rows: int = ARROW_ROWS) -> Callable:
    """``run`` on slices of at most ``rows`` rows; the session's batch size stays as it is."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.slice(lo, rows) for b in batches for lo in range(0, b.num_rows, rows))

    return few


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows a batch for the jobs run inside; the setting is restored."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    small_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the
    work, and a result used twice is computed once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a :func:`staged` table that nothing reads any more."""
    root = checkpoint_dir(spark).rstrip("/")
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        if root.split(":", 1)[-1].lstrip("/") in f:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def content_key(*cols: str | Column) -> list[Column]:
    """Two longs (128 bits) that identify a row by its content.

    Rows that agree in ``cols`` (nulls equal) share the key, so repeated rows
    get the same answer and no row number has to survive a recomputation.
    """
    parts = []
    for c in cols:
        c = F.col(c) if isinstance(c, str) else c
        parts += [F.isnull(c), c]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(0x5EED), *parts).alias("k2")]


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or it with underscores when the input has that column."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (null: none)."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def grouped_batches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Re-cut batches sorted by ``key`` so that no key straddles two of them.

    Holds one batch and the rows of its last key.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows == 0:
            continue
        k = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held:
            last = held[-1]
            end = last.column(last.schema.get_field_index(key))[last.num_rows - 1].as_py()
            if end != k[0]:
                yield pa.Table.from_batches(held)
                held = []
        cut = int(np.searchsorted(k, k[-1]))  # first row of the last key
        if cut:
            yield pa.Table.from_batches([*held, b.slice(0, cut)])
            held = [b.slice(cut)]
        else:
            held.append(b)
    if held:
        yield pa.Table.from_batches(held)
