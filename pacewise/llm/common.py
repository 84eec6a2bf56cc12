"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a word is a run of anything but the six ASCII white-space characters.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns whose name equals one of ``names`` in any letter case.

    Every operator names its result columns; an input column of the same name gives way to it.
    """
    gone = {n.lower() for n in names}
    return df.select(*[df[f"`{c.replace('`', '``')}`"] for c in df.columns if c.lower() not in gone])


def appended(df: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *fields])


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of ``column``; one long text is one slice.

    Bounds what a task holds while it builds results that are larger than their texts.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(np.asarray(sizes, dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; a null text counts as an empty one."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def extend(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def hex_sha256(column: Column | str) -> Column:
    return F.sha2(column, 256)


def split_words(text: str) -> list[str]:
    """Words between ASCII white space, unchanged (``str.split`` alone knows more spaces)."""
    return text.split() if text.isascii() and not _CONTROL.intersection(text) else _split(text)


_CONTROL = frozenset("\x1c\x1d\x1e\x1f")


def _split(text: str) -> list[str]:
    return [w.decode() for w in text.encode("utf-8", "surrogatepass").split()]
