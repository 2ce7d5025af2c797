"""Helpers shared by the operators: intermediate tables and word splitting.

Intermediates go to the folder the cluster names in ``spark.checkpoint.dir``
(tests and local runs get a fresh one): a lost executor never loses them, and
a stage that reads them does not recompute what made them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from ..sources.sinks import delete_path


def table_path(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; with
    ``file_rows`` no file has more rows."""
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path  # for drop_table
    return out


def drop_table(df: DataFrame | None) -> None:
    """Remove an intermediate that no later plan reads."""
    path = getattr(df, "_llm_path", None)
    if path:
        delete_path(df.sparkSession, path)


# Bytes for bytes: A-Z to lower case, every byte of the class to a space.
# UTF-8 keeps ASCII bytes out of longer characters, so splitting bytes is
# splitting text.
def _table(separator) -> bytes:
    out = bytearray(range(256))
    for b in range(256):
        c = b + 32 if 0x41 <= b <= 0x5A else b
        out[b] = 0x20 if separator(c) else c
    return bytes(out)


ALNUM_TABLE = _table(lambda c: c < 0x80 and not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A))


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.translate(ALNUM_TABLE).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text."""
    return text.lower().split() if text else []


def replace_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with some columns exchanged (same names, same order)."""
    cols = [new.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
    return pa.RecordBatch.from_arrays(
        [c.cast(f.type) if c.type != f.type else c for c, f in zip(cols, batch.schema)],
        schema=batch.schema)


def slices(batch: pa.RecordBatch, column: int, rows: int = 1024, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` rows and, unless one row alone is
    longer, ``size`` bytes of a text or binary column. What Arrow holds of earlier
    parts goes back to the system, since a worker lives on through many stages."""
    col = batch.column(column)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    ends = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1] if (
        len(col)) else np.zeros(1, np.int64)
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(ends, int(ends[lo]) + size, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
    pa.default_memory_pool().release_unused()
