"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: A word: a run of bytes other than ASCII blanks (what ``bytes.split`` gives).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20,
           text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``max_bytes`` of text (at least a row each)."""
    for batch in batches:
        sizes = np.cumsum([0, *(x or 0 for x in pc.binary_length(batch.column(text)).to_pylist())])
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(sizes, sizes[start] + max_bytes, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
