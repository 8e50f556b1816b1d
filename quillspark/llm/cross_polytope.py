"""Approximate nearest neighbours by inner product with cross-polytope hashing.

Signs and Hadamard transforms, three times over, turn a unit vector; its hash is the nearest signed axis. Every row goes to one bucket in each table, a
query looks into the buckets of its nearest ``probes`` axes. What it meets there is ranked by exact inner products. If the rows differ in length, one
further coordinate makes all of them equally long without changing any inner product with a query, so that nearest by angle is nearest by product.

A query that meets fewer rows than it asks for is compared with all rows, in blocks. Of rows with the same vector only the ``k + 1`` with the smallest
ids can be among the nearest, so only they are indexed; no other row is left out.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id take no part, neither as query nor as
row. Repeated ids count once (by the smallest vector in byte order). Vectors are compared with those of the same length. Ties go to the smaller id.
Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .near_vectors import matrix, usable
from .shared import as_table, stored

TABLES = 8
PROBES = 16
BLOCK = 2_048
SALTS = 64


def usable_rows(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id, bytes, width, norm`` of the rows that take part, one per id."""
    schema = pa.schema([("vec_id", pa.int64()), ("bytes", pa.binary()), ("norm", pa.float64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [usable(x)[0] for x in batch.column("vector")]
            norms = [None if x is None else float(np.linalg.norm(np.frombuffer(x))) for x in raw]
            yield as_table({"vec_id": batch.column("vec_id"), "bytes": raw, "norm": norms}, schema)

    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    found = kept.filter(F.col("vec_id").isNotNull()).mapInArrow(rows, "vec_id long, bytes binary, norm double").filter(F.col("bytes").isNotNull())
    once = found.groupBy("vec_id").agg(F.min(F.struct("bytes", "norm")).alias("x"))
    return stored(once.select("vec_id", "x.bytes", (F.octet_length("x.bytes") / 8).cast("int").alias("width"), "x.norm"), "vectors")


def first_copies(rows: DataFrame, most: int) -> DataFrame:
    """Rows among the ``most`` smallest ids of their vector; a common vector is first thinned in parts."""
    mark = rows.withColumn("mark", F.sha2("bytes", 256)).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    parts = mark.withColumn("place", F.row_number().over(W.partitionBy("mark", "salt").orderBy("vec_id"))).filter(F.col("place") <= most)
    return parts.withColumn("place", F.row_number().over(W.partitionBy("mark").orderBy("vec_id"))).filter(F.col("place") <= most).select(
        "vec_id", "bytes", "width", "norm")


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Pseudo-rotation of the rows: three rounds of random signs and a fast Hadamard transform over a power of two of coordinates."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    out = np.zeros((len(x), size))
    out[:, :x.shape[1]] = x
    signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], size=(3, size))
    for r in range(3):
        out *= signs[r]
        half = 1
        while half < size:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), size)
            half *= 2
        out /= np.sqrt(size)
    return out


def hashed(rows: DataFrame, longest: float, even: bool, tables: int, probes: int, seed: int, as_query: bool) -> DataFrame:
    """``vec_id, bytes, width, table, bucket``: a row in the bucket of its nearest axis per table, a query in those of its nearest ``probes`` axes."""
    schema = pa.schema([("vec_id", pa.int64()), ("bytes", pa.binary()), ("width", pa.int32()), ("table", pa.int32()), ("bucket", pa.int32())])

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                x = matrix(part.column("bytes"))
                if not even:
                    norms = np.linalg.norm(x, axis=1, keepdims=True)
                    x = np.hstack([x / norms, np.zeros_like(norms)]) if as_query else np.hstack(
                        [x / longest, np.sqrt(np.maximum(0, 1 - (norms / longest) ** 2))])
                for table in range(tables):
                    turn = turned(x, table, seed)
                    both = np.concatenate([turn, -turn], axis=1)
                    near = min(probes, both.shape[1]) if as_query else 1
                    axes = np.argpartition(-both, near - 1, axis=1)[:, :near] if near < both.shape[1] else np.tile(np.arange(near), (len(both), 1))
                    taken = part.take(pa.array(np.repeat(np.arange(len(x)), near)))
                    yield as_table({"vec_id": taken.column("vec_id"), "bytes": taken.column("bytes"), "width": taken.column("width"),
                                    "table": [table] * len(taken), "bucket": axes.ravel().astype(np.int32)}, schema)

    return rows.select("vec_id", "bytes", "width").mapInArrow(out, "vec_id long, bytes binary, width int, table int, bucket int")


def nearest_in_blocks(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` nearest rows of each query within every block of its buckets.

    Rows and queries of a bucket are cut into blocks; a task has one block of each. The table of bucket sizes has a line per table and axis.
    """
    key = ["width", "table", "bucket"]
    blocks = lambda df, name: df.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    sizes = stored(blocks(rows, "row_blocks").join(blocks(queries, "query_blocks"), key), "buckets")
    spots = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    left = rows.join(sizes, key).select("vec_id", "bytes", *key, own("row_blocks").alias("r"), spots("query_blocks").alias("q"), F.lit(False).alias("asks"))
    right = queries.join(sizes, key).select("vec_id", "bytes", *key, spots("row_blocks").alias("r"), own("query_blocks").alias("q"), F.lit(True).alias("asks"))

    def search(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids = table.column("vec_id").to_numpy()
        x = matrix(table.column("bytes"))
        found = {"query_id": [], "vec_id": [], "score": []}
        rows_at, asks_at = np.flatnonzero(~asks), np.flatnonzero(asks)
        if len(rows_at) and len(asks_at):
            for at in range(0, len(asks_at), 256):
                part = asks_at[at:at + 256]
                score = x[part] @ x[rows_at].T
                score[ids[part][:, None] == ids[rows_at][None, :]] = -np.inf
                keep = min(k, len(rows_at))
                edge = np.partition(score, len(rows_at) - keep, axis=1)[:, len(rows_at) - keep]
                near = (score >= (edge - 1e-12 * np.maximum(1, np.abs(edge)))[:, None]) & np.isfinite(score)
                for i, row in enumerate(near):
                    hit = rows_at[np.flatnonzero(row)]
                    exact = (x[hit] * x[part[i]]).sum(axis=1)
                    order = np.lexsort((ids[hit], -exact))[:k]
                    found["query_id"].append(np.full(len(order), ids[part[i]]))
                    found["vec_id"].append(ids[hit][order])
                    found["score"].append(exact[order])
        join = lambda c, t: pa.array(np.concatenate(found[c]) if found[c] else [], t)
        return pa.table({"query_id": join("query_id", pa.int64()), "vec_id": join("vec_id", pa.int64()), "score": join("score", pa.float64())})

    return left.unionAll(right).groupBy(*key, "r", "q").applyInArrow(search, "query_id long, vec_id long, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query: Column, k: int = 20, tables: int = TABLES, probes: int = PROBES, seed: int = 5, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (over ``vec_id``) holds, its ``k`` nearest other rows."""
    rows = usable_rows(vectors, id_column, vector_column)
    index = stored(first_copies(rows, k + 1), "index")
    low, high = rows.agg(F.min("norm"), F.max("norm")).first()
    even = low is None or high - low <= 1e-6 * high
    queries = rows.filter(is_query)
    met = stored(nearest_in_blocks(hashed(index, high or 1.0, even, tables, probes, seed, False),
                                   hashed(queries, high or 1.0, even, tables, probes, seed, True), k), "met")
    first = stored(ranked(met, k), "ranked")
    # The rows of a query's length, itself left out, are what it could find; the lengths are few and counted over all rows.
    there = rows.groupBy("width").agg((F.count(F.lit(1)) - 1).alias("others"))
    full = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    short = stored(queries.join(full, F.col("vec_id") == F.col("query_id"), "left").join(there, "width").filter(
        F.coalesce("n", F.lit(0)) < F.least(F.col("others"), F.lit(k))).select("vec_id", "bytes", "width"), "short")
    if short.isEmpty():
        return first
    everywhere = lambda df: df.select("vec_id", "bytes", "width", F.lit(-1).alias("table"), F.lit(0).alias("bucket"))
    rest = ranked(nearest_in_blocks(everywhere(index), everywhere(short), k), k)
    return first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionAll(rest)
