"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one representative per group.

Vectors are compared when their labels are equal. Equal vectors of a label are first made one, with a count. The others get the cell of their nearest
centre. A vector can have a partner across a border only if it lies near that border: two vectors with cosine ``c`` differ by an angle of at most
``acos(c)``, so a vector visits a cell of smaller number only when its distance to the bisecting plane allows it. Links found are therefore all links,
whatever the centres. Cells are cut into blocks of bounded size, and tasks compare two blocks. They give back counts and a local spanning star per
vector, never pairs.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label or a null id link with nothing.
Vectors of different lengths never link. Repeated rows are separate vectors that link with one another. A row is kept if it has its component's
smallest id; a row with a null id is kept. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import smallest_reachable
from .shared import as_table, stored

SAMPLE = 20_000
CENTRES = 256
PER_CENTRE = 1_000
BLOCK = 2_048
ROUNDS = 8


def unit_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """``vec_id, label, bytes, unit``: doubles as they are and scaled to length one, both as bytes; null for vectors that take no part."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("bytes", pa.binary()), ("unit", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, unit = [], []
            for x in batch.column("vector"):
                a, u = usable(x)
                raw.append(a)
                unit.append(u)
            yield as_table({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "bytes": raw, "unit": unit}, schema)

    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).cast("long").alias("label"),
                          F.col(vector_column).cast("array<double>").alias("vector"))
    return kept.mapInArrow(rows, "vec_id long, label long, bytes binary, unit binary")


def usable(x: pa.Scalar) -> tuple[bytes | None, bytes | None]:
    """A vector's doubles and those of its direction, or nulls."""
    if not x.is_valid or not len(x.values) or x.values.null_count:
        return None, None
    a = x.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
    top = np.abs(a).max()
    if not np.isfinite(top) or top == 0:
        return None, None
    scaled = a / top
    return a.tobytes(), (scaled / np.sqrt(scaled @ scaled)).tobytes()


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def centres(units: DataFrame, count: int, sample: int = SAMPLE, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Spherical k-means centres per vector length, fitted on at most ``sample`` vectors in order of a hash; cells only steer the work."""
    number = max(1, min(CENTRES, count // PER_CENTRE))
    picked = units.select("unit").orderBy(F.xxhash64("unit")).limit(sample).toArrow().column("unit").to_pylist()
    by_size: dict[int, list[bytes]] = {}
    for x in picked:
        by_size.setdefault(len(x), []).append(x)
    return {size: fitted(np.frombuffer(b"".join(xs), dtype=np.float64).reshape(len(xs), -1), min(number, len(xs)), rounds) for size, xs in by_size.items()}


def fitted(x: np.ndarray, number: int, rounds: int) -> np.ndarray:
    middle = x[:: max(1, len(x) // number)][:number].copy()
    for _ in range(rounds):
        cell = (x @ middle.T).argmax(axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, cell, x)
        length = np.linalg.norm(sums, axis=1)
        middle[length > 1e-9] = sums[length > 1e-9] / length[length > 1e-9, None]
    return middle


def cells(units: DataFrame, middles: dict[int, np.ndarray], cosine: float) -> DataFrame:
    """``node, label, copies, unit, width, cell, own``: each vector in its cell, and as a visitor in those of smaller number that may hold a partner."""
    shared = units.sparkSession.sparkContext.broadcast(middles)
    sine = float(np.sqrt(max(0.0, 1 - cosine * cosine))) + 1e-9
    schema = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("copies", pa.int64()), ("unit", pa.binary()), ("width", pa.int32()),
                        ("cell", pa.int32()), ("own", pa.bool_())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps = {}
        for size, m in shared.value.items():
            gaps[size] = np.sqrt(np.maximum(0, 2 - 2 * np.clip(m @ m.T, -1, 1)))
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("unit").to_pylist()])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                m = shared.value.get(int(size))
                if m is None:
                    m = np.ones((1, size // 8))
                near = matrix(part.column("unit")) @ m.T
                best = near.argmax(axis=1)
                gap = gaps[int(size)][best] if int(size) in gaps else np.zeros((len(best), 1))
                # |m_best| = |m_other| = 1, so the distance to the plane between them is (near_best - near_other) / |m_best - m_other|.
                visit = (near[np.arange(len(best)), best][:, None] - near <= sine * gap + 1e-12) & (np.arange(len(m))[None, :] < best[:, None])
                who, where = np.nonzero(visit)
                at = np.concatenate([np.arange(len(best)), who])
                taken = part.take(pa.array(at))
                yield as_table({"node": taken.column("node"), "label": taken.column("label"), "copies": taken.column("copies"), "unit": taken.column("unit"),
                                "width": [int(size) // 8] * len(at), "cell": np.concatenate([best, where]).astype(np.int32),
                                "own": np.arange(len(at)) < len(best)}, schema)

    return units.select("node", "label", "copies", "unit").mapInArrow(
        rows, "node long, label long, copies long, unit binary, width int, cell int, own boolean")


def block_links(placed: DataFrame, cosine: float, block: int = BLOCK) -> DataFrame:
    """``node, links, root`` for each vector and pair of blocks in which it has a partner: copies linked, and the smallest node of its local group."""
    key = ["label", "width", "cell"]
    sizes = stored(placed.groupBy(*key).agg(F.ceil(F.sum(F.col("own").cast("long")) / block).cast("int").alias("own_blocks"),
                                            F.ceil(F.sum((~F.col("own")).cast("long")) / block).cast("int").alias("guest_blocks")), "cells")
    known = placed.join(sizes, key)
    own_block = F.pmod(F.xxhash64("node"), F.greatest("own_blocks", F.lit(1))).cast("int")
    guest_block = F.pmod(F.xxhash64("node"), F.greatest("guest_blocks", F.lit(1))).cast("int")
    pair = lambda a, b: F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))
    others = F.sequence(F.lit(0), F.col("own_blocks") - 1)
    guests = F.when(F.col("guest_blocks") > 0, F.transform(F.sequence(F.lit(1), F.col("guest_blocks")), lambda g: pair(own_block, -g))).otherwise(
        F.array().cast("array<struct<a:int,b:int>>"))
    spots = F.when(F.col("own"), F.concat(F.transform(others, lambda o: pair(F.least(o, own_block), F.greatest(o, own_block))), guests)).otherwise(
        F.when(F.col("own_blocks") > 0, F.transform(others, lambda o: pair(o, -1 - guest_block))).otherwise(F.array().cast("array<struct<a:int,b:int>>")))
    dealt = known.select("node", "copies", "unit", *key, "own", own_block.alias("at"), F.explode(spots).alias("spot")).select(
        "node", "copies", "unit", *key, "own", "at", "spot.a", "spot.b")

    def rows(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        side = np.where(table.column("own").to_numpy(), table.column("at").to_numpy(), b)
        left = np.flatnonzero(side == a)
        right = left if a == b else np.flatnonzero(side == b)
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        x = matrix(table.column("unit"))
        if not len(left) or not len(right):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        near = x[left] @ x[right].T >= cosine
        if a == b:
            np.fill_diagonal(near, False)
        links = near @ copies[right].astype(np.float64)
        p, q = near.nonzero()
        p, q = left[p], right[q]
        root = nodes.copy()
        while True:
            before = root.copy()
            low = np.minimum(root[p], root[q])
            np.minimum.at(root, p, low)
            np.minimum.at(root, q, low)
            if (before == root).all():
                break
        back = np.zeros(len(nodes))
        back[left] += links
        if a != b:
            back[right] += copies[left].astype(np.float64) @ near
        met = np.flatnonzero(back)
        return pa.table({"node": pa.array(nodes[met]), "links": pa.array(back[met].astype(np.int64)), "root": pa.array(root[met])})

    return dealt.groupBy(*key, "a", "b").applyInArrow(rows, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = stored(unit_vectors(vectors, id_column, vector_column, label_column).withColumn("row", F.monotonically_increasing_id()), "units")
    takes_part = F.col("unit").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    same = stored(rows.filter(takes_part).withColumn("mark", F.sha2("bytes", 256)).groupBy("label", "mark").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id")), "same")
    units = stored(rows.select("row", "unit", "label").join(same.select("node", "copies"), F.col("row") == F.col("node")), "distinct")
    placed = stored(cells(units, centres(units, units.count()), cosine), "placed")
    found = stored(block_links(placed, cosine), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = smallest_reachable(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    groups = same.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = groups.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = stored(groups.join(least, "component").join(links, "node", "left").select(
        "label", "mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "named")
    linked = rows.filter(takes_part).select("vec_id", "label", F.sha2("bytes", 256).alias("mark")).join(named, ["label", "mark"])
    alone = rows.filter(~takes_part).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionAll(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
