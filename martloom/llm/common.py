"""Helpers shared by the operators: columns by any name, words, frames stored in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import materialize, scratch_path

__all__ = ["bare", "col", "map_batches", "materialize", "read", "scratch_path", "slices", "WORD"]

# A word: a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that a task works on at a time.
BYTES_AT_ONCE = 4 << 20


def col(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bare(df: DataFrame, *made: str) -> list[str]:
    """Columns of ``df`` that an operator passes on: all but those it makes itself, in any case of letters."""
    taken = {m.lower() for m in made}
    return [c for c in df.columns if c.lower() not in taken]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow``, but columns may have any names and ``run`` yields bare lists of arrays."""
    names, made = list(df.columns), list(schema.names)
    safe = [f"c{i}" for i in range(len(made))]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in run(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches):
            yield pa.RecordBatch.from_arrays(arrays, names=safe)

    out = T.StructType([T.StructField(s, f.dataType, f.nullable) for s, f in zip(safe, schema, strict=True)])
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(go, out).toDF(*made)


def slices(batch: pa.RecordBatch, column: str, unit: int = 1, limit: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded number of bytes in ``column``; one row alone may exceed it.

    ``unit`` is the size of an element, for a column of lists.
    """
    values = batch.column(column)
    lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    start = size = 0
    for i, here in enumerate((lengths.fill_null(0).to_numpy() * unit).tolist()):
        if i > start and size + here > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += here
    if start < batch.num_rows:
        yield batch.slice(start)
