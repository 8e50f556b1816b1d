"""Dense text embeddings: a hashed projection of TF-IDF, or any model given by the caller."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vectorize import Vocabulary, steps

DIMENSIONS = 64
STEP_ENTRIES = 1 << 16


def hashed_projection(sparse: DataFrame, vocab: Vocabulary, key: str = "row_id", dims: int = DIMENSIONS) -> DataFrame:
    """Add up the weights of a text's terms with a fixed sign per (term, dimension), then scale to length one.

    The sign table has one row per vocabulary term and is broadcast; a text is projected in its own task.
    """
    sign = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.when(
        F.substring(F.md5(F.concat("term", F.lit(":"), d.cast("string"))), 1, 1) < "8", 1.0).otherwise(-1.0))
    signs = vocab.table(sparse.sparkSession).select("term_idx", sign.alias("sign")).orderBy("term_idx").toArrow()
    table = signs.column("sign").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    shared = sparse.sparkSession.sparkContext.broadcast(table)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows, idx in steps(batch, "idx", STEP_ENTRIES):
                weight = part.column("weight").flatten().to_numpy(zero_copy_only=False)
                flat = weight[:, None] * shared.value[idx.to_numpy(zero_copy_only=False)]
                raw = np.zeros((part.num_rows, dims))
                if len(rows):
                    first = np.nonzero(np.diff(rows, prepend=-1))[0]
                    raw[rows[first]] = np.add.reduceat(flat, first, axis=0)
                norm = np.sqrt((raw * raw).sum(axis=1, keepdims=True))
                unit = np.divide(raw, norm, out=np.zeros_like(raw), where=norm > 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, unit.size + 1, dims, dtype=np.int32)), pa.array(unit.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(key), lists], names=[key, "embedding"])

    out = T.StructType([sparse.schema[key], T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    return sparse.select(key, "idx", "weight").mapInArrow(project, out)


def model_embedding(df: DataFrame, text: str, make_predict_fn: Callable, batch_size: int = 64) -> DataFrame:
    """Add ``embedding`` from a model that each Python worker loads once."""
    encode = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    return df.withColumn("embedding", encode(text))
