"""Hard-negative mining with segment summaries as a filter.

Scores are inner products of integer vectors. A vector is cut into segments, and of each the mean and the deviation (the length of what differs from the
mean) are kept, for segment counts that grow level by level. For two vectors, a segment adds its length times the product of the means, plus or minus at
most the product of the deviations; the sums are bounds of the score. Pairs go through the levels, and only those whose bounds leave a chance are scored
exactly. A level that drops hardly any pairs of a task is passed over for a while; that changes the work, never the result.

Anchors are sent to the rows, in as many rounds as a bounded broadcast needs; rows are not shuffled, so a label with a third of all rows is spread as the
table is. A task gives back a few rows per anchor at most. The first pass finds the anchors' positives, the second the negatives in the windows below them.

How much the filter drops depends on the vectors: much where neighbouring components move together, little on isotropic ones (README).

Edge cases: rows with a null id or label, a null vector, or a null or non-finite component take no part. Vectors of different lengths are not compared;
empty vectors have score 0 with one another. Of several rows with an anchor's id the first in order of label and vector is the anchor; as partners,
repeated rows count each, and a row is no partner of an anchor with its own id. A score that does not fit a long raises ``OverflowError``. Empty tables
give no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored

LEVELS = (4, 16, 32)
ROUND_BYTES = 32 << 20
ANCHORS, ROWS = 512, 2048
FEW = 0.2
EXACT = float(1 << 53)


def segments(values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean times the root of the length, and deviation, of ``count`` segments of each row; products of the former add up to the middle of the bounds."""
    edges = np.linspace(0, values.shape[1], min(count, values.shape[1]) + 1).astype(int)
    size = np.diff(edges)
    mean = np.add.reduceat(values, edges[:-1], axis=1) / size
    rest = values - np.repeat(mean, size, axis=1)
    return mean * np.sqrt(size), np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))


@dataclass
class Side:
    """Vectors of one length with their ids, labels and summaries."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def summarised(self, levels: tuple[int, ...] = LEVELS) -> Side:
        d = self.values.shape[1]
        self.levels = [segments(self.values, n) for n in levels if n < d]
        return self

    def take(self, rows: np.ndarray | slice) -> Side:
        return Side(self.ids[rows], self.labels[rows], self.values[rows], [(m[rows], s[rows]) for m, s in self.levels])

    def __len__(self) -> int:
        return len(self.ids)


def scores(a: np.ndarray, x: np.ndarray, pairs: bool) -> np.ndarray:
    """Exact inner products as long: of rows with rows, or of all with all."""
    most = a.shape[1] * np.abs(a).max(initial=0) * np.abs(x).max(initial=0)
    if most < EXACT:
        return (np.einsum("ij,ij->i", a, x) if pairs else a @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in a], [[int(v) for v in row] for row in x]
    if pairs:
        return np.array([sum(map(int.__mul__, p, q)) for p, q in zip(*whole)], dtype=np.int64)
    return np.array([[sum(map(int.__mul__, p, q)) for q in whole[1]] for p in whole[0]], dtype=np.int64).reshape(len(a), len(x))


class Filter:
    """Sends pairs through the levels. ``seen`` and ``scored`` count pairs that came in and pairs that were scored exactly."""

    def __init__(self) -> None:
        self.seen = self.scored = self.calls = 0
        self.idle: dict[int, int] = {}

    def __call__(self, a: Side, x: Side, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of every pair of ``alive`` with ``low <= score <= high`` (by anchor), and of no others."""
        self.calls += 1
        self.seen += int(alive.sum())
        r = c = None
        for n, ((am, ad), (xm, xd)) in enumerate(zip(a.levels, x.levels)):
            if self.idle.get(n, 0) > self.calls:
                continue
            if r is None and alive.mean() < FEW:
                r, c = np.nonzero(alive)
            if r is None:
                middle, reach = am @ xm.T, ad @ xd.T
                lowest, highest = low[:, None], high[:, None]
            else:
                middle, reach = np.einsum("ij,ij->i", am[r], xm[c]), np.einsum("ij,ij->i", ad[r], xd[c])
                lowest, highest = low[r], high[r]
            reach = reach + 1e-9 * (np.abs(middle) + reach) + 1e-6
            kept = (middle + reach >= lowest) & (middle - reach <= highest)
            before = alive.sum() if r is None else len(r)
            if r is None:
                alive = alive & kept
                after = alive.sum()
            else:
                r, c = r[kept], c[kept]
                after = len(r)
            if before and after > 0.9 * before:
                self.idle[n] = self.calls + 16
        if r is None and alive.mean() < FEW:
            r, c = np.nonzero(alive)
        if r is None:
            found = scores(a.values, x.values, False)
            self.scored += int(alive.sum())
            r, c = np.nonzero(alive & (found >= low[:, None]) & (found <= high[:, None]))
            return r, c, found[r, c]
        self.scored += len(r)
        found = scores(a.values[r], x.values[c], True)
        kept = (found >= low[r]) & (found <= high[r])
        return r[kept], c[kept], found[kept]


class Best:
    """The ``k`` best (score descending, id ascending) of each of ``n`` lists."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.row, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.least = np.full(n, -np.inf)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        chance = score >= self.least[row]
        row, score, ids = (np.concatenate([old, new[chance]]) for old, new in ((self.row, row), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        kept = place < self.k
        self.row, self.score, self.id = row[kept], score[kept], ids[kept]
        last = place[kept] == self.k - 1
        self.least[self.row[last]] = self.score[last]


def sides(batch: pa.RecordBatch | pa.Table, scale: float, id_column: str = "vec_id") -> dict[int, Side]:
    """The rows that take part, by vector length."""
    ids, labels, vectors = batch.column(id_column).to_pylist(), batch.column("label").to_pylist(), batch.column("embedding")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    rows: dict[int, list[int]] = {}
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sizes = np.array([-1 if n is None else n for n in vectors.value_lengths().to_pylist()], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
    for i, n in enumerate(sizes.tolist()):
        if n >= 0 and ids[i] is not None and labels[i] is not None and bad[start[i]] == bad[start[i + 1]]:
            rows.setdefault(n, []).append(i)
    made = {}
    for n, which in rows.items():
        at = start[which][:, None] + np.arange(n)[None, :]
        made[n] = Side(np.array([ids[i] for i in which], dtype=np.int64), np.array([labels[i] for i in which], dtype=np.int64),
                       np.floor(scale * flat[at]) if n else np.zeros((len(which), 0)))
    return made


def prepared(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")


def rounds_of(anchors: DataFrame, round_bytes: int) -> tuple[Column, int]:
    """A number for each anchor, such that the anchors of a number fit a broadcast, and how many numbers there are."""
    total = anchors.agg(F.sum(F.size("embedding") * 8 + 64)).first()[0] or 0
    count = max(1, -(-total // round_bytes))
    return F.pmod(F.xxhash64(F.lit(5), "vec_id"), F.lit(count)), count


def _blocks(n: int, size: int) -> Iterator[slice]:
    return (slice(i, i + size) for i in range(0, n, size))


FOUND = "anchor_id long, place long, vec_id long, score long"


def _emit(ids: np.ndarray, places: np.ndarray, best: Best) -> pa.RecordBatch:
    columns = [ids[best.row], places[best.row], best.id, best.score]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "place", "vec_id", "score"])


def _positives(rows: DataFrame, anchors: pa.Table, k: int, scale: float) -> DataFrame:
    """The ``k`` best rows of an anchor's own label in each task."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {d: s.summarised() for d, s in sides(shared.value, 1.0).items()}
        best, sift = {d: Best(len(s), k) for d, s in asked.items()}, Filter()
        for batch in batches:
            for d, side in sides(batch, scale).items():
                if d not in asked:
                    continue
                side.summarised()
                for label in np.intersect1d(side.labels, asked[d].labels):
                    mine, theirs = np.nonzero(asked[d].labels == label)[0], np.nonzero(side.labels == label)[0]
                    for i in _blocks(len(mine), ANCHORS):
                        a = asked[d].take(mine[i])
                        for j in _blocks(len(theirs), ROWS):
                            x = side.take(theirs[j])
                            r, c, s = sift(a, x, a.ids[:, None] != x.ids[None, :], best[d].least[mine[i]], np.full(len(a), np.inf))
                            best[d].add(mine[i][r], s, x.ids[c])
        for d, side in asked.items():
            yield _emit(side.ids, np.zeros(len(side), dtype=np.int64), best[d])

    return rows.mapInArrow(near, FOUND)


def _negatives(rows: DataFrame, anchors: pa.Table, positives: pa.Table, k: int, share: tuple[int, int], scale: float) -> DataFrame:
    """The ``k`` best rows of other labels in the window below each positive, in each task."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, positives))
    lower, upper = share

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, positives = shared.value
        owner, place, high = (positives.column(c).to_numpy() for c in ("anchor_id", "place", "score"))
        asked, lists = {}, {}
        for d, side in sides(anchors, 1.0).items():
            order = np.argsort(side.ids)
            at = order[np.minimum(np.searchsorted(side.ids[order], owner), len(order) - 1)]
            own = (side.ids[at] == owner) & (high >= 0)
            by = np.argsort(at[own], kind="stable")
            lists[d] = at[own][by], place[own][by], high[own][by], Best(int(own.sum()), k)
            asked[d] = side.summarised()
        sift = Filter()
        for batch in batches:
            for d, side in sides(batch, scale).items():
                if d not in asked:
                    continue
                side.summarised()
                row, _, high, best = lists[d]
                least = np.array([-(-lower * h // upper) for h in high.tolist()], dtype=np.float64)
                for i in _blocks(len(asked[d]), ANCHORS):
                    a = asked[d].take(i)
                    first, last = np.searchsorted(row, [i.start, i.start + len(a)])
                    which = row[first:last] - i.start
                    if first == last:
                        continue
                    for j in _blocks(len(side), ROWS):
                        x = side.take(j)
                        bottom, top = np.full(len(a), np.inf), np.full(len(a), -np.inf)
                        np.minimum.at(bottom, which, np.maximum(least[first:last], best.least[first:last]))
                        np.maximum.at(top, which, high[first:last].astype(np.float64))
                        r, c, s = sift(a, x, (a.labels[:, None] != x.labels[None, :]) & (a.ids[:, None] != x.ids[None, :]), bottom, top)
                        begin = np.searchsorted(which, r)
                        count = np.searchsorted(which, r, side="right") - begin
                        pair = np.repeat(np.arange(len(r)), count)
                        at = first + begin[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
                        kept = (s[pair] <= high[at]) & (s[pair] >= least[at])
                        best.add(at[kept], s[pair][kept], x.ids[c][pair][kept])
        for d, side in asked.items():
            row, place, _, best = lists[d]
            yield _emit(side.ids[row], place, best)

    return rows.mapInArrow(near, FOUND)


def _ranked(found: list[DataFrame], keys: list[str], k: int) -> DataFrame:
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionAll(more)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: float = 256.0,
         round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, embedding``; a component ``x`` counts as ``floor(scale * x)``. For an anchor and each of its ``positives`` best rows of
    its label, the ``negatives`` best rows of other labels with ``share[0] * positive_score <= share[1] * negative_score <= share[1] * positive_score``.
    """
    rows = prepared(vectors)
    whole = F.transform("embedding", lambda x: F.floor(x * scale).cast("double"))
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    asked = prepared(vectors.filter(is_anchor)).filter(F.coalesce(good, F.lit(False))).groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("r")).select(
        "vec_id", F.col("r.label").alias("label"), F.col("r.embedding").alias("embedding"))
    asked = stored(asked.select("vec_id", "label", whole.alias("embedding")), "anchors")
    number, count = rounds_of(asked, round_bytes)
    parts = [asked.filter(number == i).toArrow() for i in range(count)] if count == 1 else None
    part = (lambda i: parts[i]) if parts else (lambda i: asked.filter(number == i).toArrow())
    found = [_positives(rows, part(i), positives, scale) for i in range(count)]
    ranked = _ranked(found, ["anchor_id"], positives)
    good_ones = stored(ranked.select("anchor_id", F.col("rank").cast("long").alias("place"), F.col("vec_id").alias("positive_id"), "score"), "positives")
    owner = F.pmod(F.xxhash64(F.lit(5), "anchor_id"), F.lit(count))
    found = [_negatives(rows, part(i), good_ones.filter(owner == i).select("anchor_id", "place", "score").toArrow(), negatives, share, scale) for i in range(count)]
    ranked = _ranked(found, ["anchor_id", "place"], negatives).select("anchor_id", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return good_ones.withColumnRenamed("score", "positive_score").join(ranked, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
