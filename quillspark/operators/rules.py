"""Frequent itemsets and association rules.

Rows become arrays of item codes in the tasks that hold them. Candidates are a DataFrame, level by level: pairs are those frequent in some part of the rows
(a pair that is frequent overall is frequent in one part at least), longer sets are joined from the level before. They are counted in tasks by bitmaps, a bit
per row and item; candidates go to the tasks in blocks of bounded size, and a task gives back one count per candidate at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

COUNTERS = 1 << 25
CANDIDATES = 1 << 20
STEP_ROWS = 8192
SLICE = 1 << 14


def frequent_items(transactions: DataFrame, least: float) -> list[tuple[str, int]]:
    """Frequent items and their counts, by name; there are at most (mean items per row) / (minimum share) of them."""
    counts = transactions.select(F.explode_outer("items").alias("item")).filter(F.col("item").isNotNull()).groupBy("item").agg(
        F.count(F.lit(1)).alias("n"))
    return sorted(((r["item"], r["n"]) for r in counts.filter(F.col("n") >= least).collect()), key=lambda r: r[0].encode())


def coded_rows(transactions: DataFrame, names: list[str]) -> DataFrame:
    """``codes``: the places of a row's items in ``names``, ascending; other items are left out."""
    shared = transactions.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("items")
            sizes = pc.fill_null(pc.list_value_length(items), 0).to_numpy(zero_copy_only=False)
            found = pc.fill_null(pc.index_in(items.flatten().cast(pa.string()), value_set=shared.value), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)[found >= 0]
            pair = np.unique(row * max(len(shared.value), 1) + found[found >= 0])
            ends = np.searchsorted(pair, np.arange(len(sizes) + 1) * max(len(shared.value), 1))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((pair % max(len(shared.value), 1)).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists], names=["codes"])

    return transactions.select("items").mapInArrow(code, "codes array<int>")


def _code_lists(sets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, sets.size + 1, sets.shape[1], dtype=np.int32)), pa.array(sets.ravel().astype(np.int32)))


def _pairs_somewhere(coded: DataFrame, n_items: int, share: float) -> DataFrame:
    """``codes`` of the pairs that reach ``share`` of the rows of some task. A round counts the pairs of some first items, so that counters are bounded."""
    width = max(1, COUNTERS // max(n_items, 1))

    def counter(low: int):
        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            high, n = min(low + width, n_items), 0
            total = np.zeros((high - low, n_items), dtype=np.int32)
            for batch in batches:
                lists = batch.column("codes")
                ends, codes = lists.offsets.to_numpy(), lists.values.to_numpy()
                n += len(lists)
                for i in range(len(lists)):
                    row = codes[ends[i]:ends[i + 1]]
                    first = row[np.searchsorted(row, low):np.searchsorted(row, high)]
                    if len(first):
                        total[np.ix_(first - low, row)] += 1
            a, b = np.nonzero(total >= max(share * n * (1 - 1e-12) - 1e-6, 1)) if n else (np.zeros(0, dtype=int),) * 2
            pairs = np.stack([a + low, b], axis=1)[a + low < b]
            for i in range(0, len(pairs), CANDIDATES):
                yield pa.RecordBatch.from_arrays([_code_lists(pairs[i:i + CANDIDATES])], names=["codes"])
        return local

    found = None
    for low in range(0, n_items, width):
        made = coded.mapInArrow(counter(low), "codes array<int>")
        found = made if found is None else found.unionAll(made)
    return found.distinct()


def _joined(level: DataFrame, size: int) -> DataFrame:
    """``codes`` of the sets of ``size + 1`` items whose every part of ``size`` items is in ``level``."""
    head = lambda d, last: d.select(F.slice("codes", 1, size - 1).alias("head"), F.get("codes", F.lit(size - 1)).alias(last))
    made = head(level, "a").join(head(level, "b"), "head").filter("a < b").select(F.concat("head", F.array("a", "b")).alias("codes"))
    for left_out in range(size - 1):
        part = F.expr(f"filter(codes, (c, i) -> i != {left_out})")
        made = made.withColumn("part", part).join(level.select(F.col("codes").alias("part")), "part", "left_semi").select("codes")
    return made


def _counted(coded: DataFrame, candidates: pa.Table, n_items: int) -> DataFrame:
    """``codes, n``: the rows of each task that hold a candidate, for candidates with any."""
    sets = np.array(candidates.column("codes").combine_chunks().flatten()).reshape(candidates.num_rows, -1)
    shared = coded.sparkSession.sparkContext.broadcast(sets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shared.value
        total = np.zeros(len(sets), dtype=np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                lists = batch.column("codes").slice(start, STEP_ROWS)
                held = np.zeros((n_items, -(-len(lists) // 64) * 64), dtype=bool)
                held[lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))] = True
                bits = np.packbits(held, axis=1).view(np.uint64)
                for low in range(0, len(sets), SLICE):
                    part = sets[low:low + SLICE]
                    both = bits[part[:, 0]]
                    for j in range(1, part.shape[1]):
                        both &= bits[part[:, j]]
                    total[low:low + SLICE] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        hit = np.nonzero(total)[0]
        for low in range(0, len(hit), SLICE):
            some = hit[low:low + SLICE]
            yield pa.RecordBatch.from_arrays([_code_lists(sets[some]), pa.array(total[some])], names=["codes", "n"])

    return coded.mapInArrow(count, "codes array<int>, n long")


def _frequent(coded: DataFrame, candidates: DataFrame, n_items: int, least: float) -> DataFrame:
    """``codes, n`` of the candidates in ``least`` rows or more."""
    candidates = stored(candidates, "candidates")
    rounds = max(1, -(-candidates.count() // CANDIDATES))
    sums = None
    for i in range(rounds):
        block = candidates.filter(F.pmod(F.xxhash64(F.lit(3), "codes"), F.lit(rounds)) == i).toArrow()
        if block.num_rows:
            made = _counted(coded, block, n_items).groupBy("codes").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
            sums = made if sums is None else sums.unionAll(made)
    return stored(sums if sums is not None else candidates.select("codes", F.lit(0).cast("long").alias("n")), "level")


def _named(sets: DataFrame, names: list[str]) -> DataFrame:
    shared = sets.sparkSession.sparkContext.broadcast(pa.array(names, pa.string()))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("codes")
            items = pa.ListArray.from_arrays(pc.subtract(codes.offsets, codes.offsets[0]), shared.value.take(codes.flatten()))
            yield pa.RecordBatch.from_arrays([items, batch.column("n")], names=["items", "freq"])

    return sets.mapInArrow(name, "items array<string>, freq long")


def frequent_itemsets(transactions: DataFrame, min_support: float = 0.01, max_len: int | None = None) -> DataFrame:
    """``(items, freq, support)`` of every itemset in at least ``min_support`` of the rows; ``items`` are sorted.

    ``transactions`` has an array column ``items`` without repeats. Levels go on until no candidate is left, or to ``max_len``.
    """
    spark = transactions.sparkSession
    n = transactions.count()
    least = min_support * n - 1e-9
    singles = frequent_items(transactions, max(least, 1))
    names = [s for s, _ in singles]
    found = spark.createDataFrame([([i], c) for i, (_, c) in enumerate(singles)], "codes array<int>, n long")
    size = 1
    if names and (max_len is None or max_len > 1):
        coded = stored(coded_rows(transactions, names), "coded")
        level, size = _frequent(coded, _pairs_somewhere(coded, len(names), min_support), len(names), least), 2
        while not level.isEmpty():
            found = found.unionAll(level)
            if size == max_len:
                break
            level, size = _frequent(coded, _joined(level, size), len(names), least), size + 1
    return _named(found, names).withColumn("support", F.col("freq") / n)


def association_rules(itemsets: DataFrame, metric: str = "lift", min_threshold: float = 1.2) -> DataFrame:
    """Every split of every itemset into antecedent and consequent, with support, confidence, lift, leverage and conviction."""
    several = itemsets.filter(F.size("items") > 1)
    masks = F.sequence(F.lit(1), (F.pow(F.lit(2), F.size("items")) - 2).cast("int"))
    split = several.select("items", "support", F.explode(masks).alias("mask"))

    def side(bit: int) -> F.Column:
        return F.expr(f"filter(items, (x, i) -> (shiftright(mask, i) & 1) = {bit})")

    sides = split.select("support", side(1).alias("antecedent"), side(0).alias("consequent"))
    known = itemsets.select("items", F.col("support").alias("s"))
    sides = sides.join(known.select(F.col("items").alias("antecedent"), F.col("s").alias("a")), "antecedent")
    sides = sides.join(known.select(F.col("items").alias("consequent"), F.col("s").alias("c")), "consequent")
    s, a, c = F.col("support"), F.col("a"), F.col("c")
    confidence = s / a
    rules = sides.select(
        "antecedent", "consequent", a.alias("antecedent_support"), c.alias("consequent_support"), "support",
        confidence.alias("confidence"), (confidence / c).alias("lift"), (s - a * c).alias("leverage"),
        F.when(confidence < 1, (1 - c) / (1 - confidence)).otherwise(F.lit(float("inf"))).alias("conviction"))
    return rules.filter(F.col(metric) >= min_threshold)


def top_rules(rules: DataFrame, top: int = 10) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent").limit(top)
