"""Helpers shared by the operators on training data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import bound_batches, discard, reach_workers, release, scratch_dir, stored  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Every ASCII byte but a-z and 0-9 ends a word; all bytes of other characters belong to words.
_BREAKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(column, UPPER, LOWER)


def alnum_words(text: str | None) -> list[bytes]:
    """Words of lower-case letters, digits and non-ASCII characters, as UTF-8, after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8, after lower-casing A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def column(name: str) -> Column:
    """A column by its name, whatever signs that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def arrow_map(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with workers that can import this library, and batches of at most ``ARROW_BYTES`` or the session's lower limit."""
    reach_workers(df.sparkSession)
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut to at most so many rows each."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a part's texts have at most so many bytes, or it is one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop
