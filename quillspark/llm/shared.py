"""Helpers that several operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import forget as forget
from ..session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and safe against lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`stored`, with the path, for :func:`forget`."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dealt(df: DataFrame) -> DataFrame:
    """Mark a join side whose size Spark can take too low: rows are dealt out by key, and neither side goes through the driver."""
    return df.hint("merge")


def arrow_rows(df: DataFrame, schema: T.StructType | str, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    return df.mapInArrow(rows, schema)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of a text or binary column take about ``limit`` bytes, or are one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def as_table(columns: dict[str, Sequence], schema: pa.Schema) -> pa.RecordBatch:
    made = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def words_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def tasks_for(rows: int, each: int) -> int:
    return max(1, -(-rows // each))
