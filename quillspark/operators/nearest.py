"""Exact k nearest neighbours for batches of queries.

Distances are computed block by block with matrix products inside tasks, and each task hands on only the
best ``k`` rows per query, so the pairs themselves are never rows of a DataFrame. A query side whose size
was checked is broadcast and the items stay where they are. A larger query side meets the items on a grid of
fixed-size blocks, spread by hash, so no block depends on how keys are distributed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 128 << 20
QUERY_BLOCK = 2048
ITEM_BLOCK = 16384
STEP_ROWS = 2048
DIGITS = 9
SLACK = 2 * 10.0 ** -DIGITS
PAIRS = 500_000_000


def _matrix(vectors: pa.Array, idx: pa.Array | None, dim: int) -> np.ndarray:
    """Dense rows from list arrays: whole vectors, or index and weight lists."""
    n = len(vectors)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if idx is None:
        return values.reshape(n, dim)
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((n, dim))
    out[np.repeat(np.arange(n), sizes), idx.flatten().to_numpy(zero_copy_only=False)] = values
    return out


def _columns(batch: pa.RecordBatch | pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    def whole(name: str) -> pa.Array:
        col = batch.column(name)
        return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col

    idx = whole("idx") if "idx" in batch.schema.names else None
    return np.array(whole("id").to_pylist()), _matrix(whole("vector"), idx, dim)


class Best:
    """The ``k`` nearest items seen so far for each query, ties by id."""

    def __init__(self, query_vectors: np.ndarray, k: int, metric: str, reached: np.ndarray | None = None):
        """``reached`` are distances beyond which items are not wanted."""
        self.q, self.k, self.metric = query_vectors, k, metric
        if metric == "cosine":
            self.q = _unit(query_vectors)
        self.q2 = (self.q * self.q).sum(axis=1)[:, None]
        self.far = np.full(len(self.q), np.inf) if reached is None else reached.astype(np.float64)
        self.row = np.zeros(0, dtype=np.int64)
        self.dist = np.zeros(0)
        self.ids: np.ndarray | None = None

    def add(self, ids: np.ndarray, vectors: np.ndarray, only: np.ndarray | None = None) -> None:
        """Compare items with all queries, or with the places ``only``. Few pairs are within the distances reached so far, and only those are rounded."""
        if not len(ids) or not len(self.q):
            return
        q, q2, far = (self.q, self.q2, self.far) if only is None else (self.q[only], self.q2[only], self.far[only])
        x = _unit(vectors) if self.metric == "cosine" else vectors
        dist = q @ x.T
        if self.metric == "cosine":
            np.subtract(1.0, dist, out=dist)
        else:
            dist *= -2.0
            dist += q2 + (x * x).sum(axis=1)
            np.maximum(dist, 0.0, out=dist)
        new = np.isinf(far)
        if dist.shape[1] > self.k and new.any():
            far = far.copy()
            far[new] = np.partition(dist[new], self.k - 1, axis=1)[:, self.k - 1]
        inside = dist <= (far + SLACK)[:, None]
        if dist.shape[1] <= self.k:
            inside[new] = True
        rows, cols = np.nonzero(inside)
        near = np.round(dist[rows, cols], DIGITS) + 0.0
        self._merge(rows if only is None else only[rows], near, ids[cols])

    def _merge(self, rows: np.ndarray, dist: np.ndarray, ids: np.ndarray) -> None:
        if self.ids is not None:
            rows, dist = np.concatenate([self.row, rows]), np.concatenate([self.dist, dist])
            ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, dist, rows))
        rows, dist, ids = rows[order], dist[order], ids[order]
        first = np.searchsorted(rows, rows, side="left")
        keep = np.arange(len(rows)) - first < self.k
        self.row, self.dist, self.ids = rows[keep], dist[keep], ids[keep]
        full = (np.arange(len(rows)) - first == self.k - 1)
        self.far[rows[full]] = np.fmin(self.far[rows[full]], dist[full])

    def table(self, query_ids: np.ndarray, schema: pa.Schema) -> pa.Table:
        ids = self.ids if self.ids is not None else np.zeros(0, dtype=np.int64)
        cols = [query_ids[self.row].tolist(), ids.tolist(), self.dist.tolist()]
        return pa.table([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.int64() if isinstance(kind, (T.LongType, T.IntegerType)) else pa.string()


def _dimension(df: DataFrame) -> int:
    first = df.select(F.size("vector")).head()
    return int(first[0]) if first else 0


def top_k(queries: DataFrame, items: DataFrame, k: int = 5, metric: str = "l2", dim: int | None = None,
          broadcast_bytes: int = BROADCAST_BYTES, cells: bool | None = None, counter=None) -> DataFrame:
    """``(q_id, item_id, distance, rank)``: the ``k`` items nearest to each query.

    With ``cells``, for dense vectors, only cells of items that can hold one of the nearest are compared (see :mod:`.cells`). None chooses cells from
    ``PAIRS`` pairs on. The result is the same.

    Both sides have ``id`` and ``vector`` (dense), or ``id``, ``idx`` and ``vector`` (sparse, with ``dim``).
    ``metric`` is ``"l2"`` (squared Euclidean) or ``"cosine"`` (one minus cosine). Ids are unique on each side.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError("metric must be 'l2' or 'cosine'")
    if k < 1:
        raise ValueError("k must be at least 1")
    cols = [c for c in ("id", "idx", "vector") if c in items.columns]
    queries = queries.select(*cols).filter(F.col("vector").isNotNull())
    items = items.select(*cols).filter(F.col("vector").isNotNull())
    dim = dim if dim is not None else _dimension(queries)
    q_type, i_type = queries.schema["id"].dataType, items.schema["id"].dataType
    schema = pa.schema([("q_id", _arrow(q_type)), ("item_id", _arrow(i_type)), ("distance", pa.float64())])
    out = T.StructType([T.StructField("q_id", q_type if pa.types.is_string(schema[0].type) else T.LongType()),
                        T.StructField("item_id", i_type if pa.types.is_string(schema[1].type) else T.LongType()),
                        T.StructField("distance", T.DoubleType())])
    most = max(1, broadcast_bytes // (8 * max(dim, 1)))
    head = queries.limit(most + 1).toArrow()
    if cells is None and "idx" not in cols:
        cells = head.num_rows * items.count() > PAIRS
    if cells:
        from .cells import near_in_cells

        found = near_in_cells(queries, items, k, metric, dim, schema, out, counter=counter)
    elif head.num_rows <= most:
        found = _near_broadcast(head, items, k, metric, dim, schema, out)
    else:
        found = _near_grid(queries, items, k, metric, dim, schema, out)
    place = F.row_number().over(W.partitionBy("q_id").orderBy("distance", "item_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def _near_broadcast(queries: pa.Table, items: DataFrame, k: int, metric: str, dim: int,
                    schema: pa.Schema, out: T.StructType) -> DataFrame:
    query_ids, vectors = _columns(queries, dim)
    shared = items.sparkSession.sparkContext.broadcast((query_ids, vectors))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = shared.value
        blocks = [(ids[i:i + QUERY_BLOCK], Best(matrix[i:i + QUERY_BLOCK], k, metric))
                  for i in range(0, len(ids), QUERY_BLOCK)]
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                item_ids, x = _columns(batch.slice(start, STEP_ROWS), dim)
                for _, best in blocks:
                    best.add(item_ids, x)
        for block_ids, best in blocks:
            yield from best.table(block_ids, schema).to_batches()

    return items.mapInArrow(near, out)


def _near_grid(queries: DataFrame, items: DataFrame, k: int, metric: str, dim: int,
               schema: pa.Schema, out: T.StructType) -> DataFrame:
    n_q = -(-queries.count() // QUERY_BLOCK)
    n_i = max(1, -(-items.count() // ITEM_BLOCK))

    def cut(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
        return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = cut(queries, "qb", n_q, "ib", n_i).groupBy("qb", "ib")
    right = cut(items, "ib", n_i, "qb", n_q).groupBy("qb", "ib")

    def near(q: pa.Table, x: pa.Table) -> pa.Table:
        query_ids, vectors = _columns(q, dim)
        best = Best(vectors, k, metric)
        for start in range(0, x.num_rows, STEP_ROWS):
            best.add(*_columns(x.slice(start, STEP_ROWS), dim))
        return best.table(query_ids, schema)

    return left.cogroup(right).applyInArrow(near, out)


def where_clause(rule: dict) -> F.Column:
    """A metadata filter as a column predicate: ``{"label": 3}``, ``{"page": {"$gte": 2}}``, ``{"$or": [..]}``."""
    compare = {
        "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v, "$gt": lambda c, v: c > v,
        "$gte": lambda c, v: c >= v, "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
        "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v)),
    }
    parts = []
    for key, want in rule.items():
        if key in ("$and", "$or"):
            inner = [where_clause(r) for r in want]
            joined = inner[0]
            for part in inner[1:]:
                joined = joined & part if key == "$and" else joined | part
            parts.append(joined)
        elif isinstance(want, dict):
            for op, value in want.items():
                if op not in compare:
                    raise ValueError(f"unknown filter operator {op}")
                parts.append(compare[op](F.col(key), value))
        else:
            parts.append(F.col(key) == want)
    if not parts:
        raise ValueError("an empty filter")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole & part
    return whole
