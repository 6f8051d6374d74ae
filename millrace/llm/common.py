"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are worked on at once inside a task.
CHUNK = 1_000_000
#: Rows with whole texts that a task sends back at once; the reading side holds as much outside its heap.
PORTION = 500


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 2


def sample_share(counts: dict, most: int) -> dict:
    """Share of the rows of each class that gives about ``most`` rows of it."""
    return {k: min(1.0, most / n) for k, n in counts.items() if n}


def drawn(doc_id: Column, salt: str) -> Column:
    """A repeatable number in [0, 1) for each id."""
    text = F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.crc32(text.cast("binary")) / F.lit(float(1 << 32))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 row bounds in them; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    row, n = 0, len(bounds) - 1
    while row < n:
        end = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def portions(batches: Iterator[pa.RecordBatch], rows: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``; nothing is copied."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
