"""Mixing sources to target weights by Sainte-Lague apportionment.

All words of the mix are dealt in blocks of equal size. Sources get whole blocks by the highest quotients ``target / (2 * blocks + 1)``, then the
shards of each source get theirs in the same way; a source has a shard per ``SHARD_BLOCKS`` blocks of its words. What whole blocks leave between a source's
words and its target is made up by part blocks in its shards, as far as their limits allow, so a source takes its target to the word, whatever the size of a
block. A shard's documents stand in seeded order on a ring of words; the shard takes its blocks from a seeded block on, round the ring as often as needed.

Edge cases: a null text has size 0; a null source is a source of its own, last in order. A source without words has target 0. Repeated rows count
as often as they occur. With no words at all every target and every taken number is 0. Other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import stored, words_count

BLOCKS = 1 << 20
LARGEST_BLOCK = 1 << 22
SHARD_BLOCKS = 1 << 10
MOST_REPEATS = 3


def sized_documents(docs: DataFrame, seed: int, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Ids, sources, sizes, and seeded numbers for shard and place; stored, as every later step needs it. ``gone`` marks a null source."""
    kept = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(source_column).cast("string").alias("source"),
                       words_count(F.col(text_column)).alias("size"))
    return stored(kept.select(
        "doc_id", F.col("source").isNull().alias("gone"), F.coalesce("source", F.lit("")).alias("name"), "size",
        F.xxhash64(F.lit(seed), "doc_id", "size").alias("spot"),
        F.xxhash64(F.lit(seed + 1), "doc_id", "size").alias("place")), "sized")


def in_order(sources: DataFrame) -> DataFrame:
    """Add ``rank``, from 0 in order of (``gone``, ``name``), without gathering all sources in one task."""
    ranged = stored(sources.repartitionByRange(F.col("gone"), F.col("name")).withColumn("part", F.spark_partition_id()), "ranged")
    local = F.row_number().over(W.partitionBy("part").orderBy("gone", "name")) - 1
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))  # a row per partition
    return ranged.withColumn("local", local).join(before, "part").withColumn("rank", F.col("local") + F.col("before")).drop("part", "local", "before")


def targets(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST_REPEATS) -> DataFrame:
    """Add ``target`` to one row per source with ``size``: shares by weight, at most ``most`` times the source's size.

    Each round asks for two sums and caps the sources above their limit; the set of capped sources only grows, so it ends.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("rank") % len(cycle) + 1).cast("int"))
    ranked = stored(in_order(sources).withColumn("weight", weight), "weights")
    limit = F.col("size").cast("double") * most
    total = float(ranked.agg(F.sum("size")).first()[0] or 0)
    rate, capped = 0.0, -1
    while total:
        over = F.col("weight") * rate >= limit
        n, held, open_weight = ranked.agg(F.sum(over.cast("long")), F.sum(F.when(over, limit).otherwise(0.0)),
                                          F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if n == capped or not open_weight:
            break
        capped, rate = n, (total - held) / open_weight
    return ranked.withColumn("target", F.least(F.col("weight") * rate, limit))


def apportion(units: DataFrame, value: Column, seats: int, key: list[str]) -> DataFrame:
    """Add ``seats``: Sainte-Lague with one seat at a time to the highest quotient, ties to the smaller key.

    Giving seats by highest quotients is the same as rounding ``value / divisor`` for the divisor that seats everyone. Each job tries 256 divisors at
    once; what the last interval leaves open goes by quotient.
    """
    held = units.withColumn("_v", value.cast("double"))
    total = held.agg(F.sum("_v")).first()[0]
    if not total or seats <= 0:
        return held.withColumn("seats", F.lit(0).cast("long")).drop("_v")
    n = held.count()
    low, high = total / (seats + n), 2 * total * (1 + n / seats) + 1
    given = lambda d: F.floor(F.col("_v") / d + 0.5).cast("long")
    for _ in range(6):
        grid = [low + (high - low) * k / 256 for k in range(257)]
        tried = held.select("_v", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(d).alias("d")) for k, d in enumerate(grid)])).alias("g"))
        sums = dict(tried.groupBy("g.k").agg(F.sum(given(F.col("g.d")))).collect())
        first = next((k for k in range(257) if sums[k] <= seats), 256)
        if first == 0:
            high = low
            break
        low, high = grid[first - 1], grid[first]
        if sums[first] == seats:
            break
    base = held.withColumn("seats", given(high))
    left = seats - (base.agg(F.sum("seats")).first()[0] or 0)
    if left <= 0:
        return base.drop("_v")
    extra = base.filter(F.col("_v") > 0).orderBy((F.col("_v") / (2 * F.col("seats") + 1)).desc(), *key).limit(left)
    more = extra.select(*[F.col(k).alias(f"_{k}") for k in key], F.lit(1).alias("_more"))
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    return base.join(more, same, "left").withColumn("seats", F.col("seats") + F.coalesce("_more", F.lit(0))).drop("_v", "_more", *[f"_{k}" for k in key])


def highest_quotients(values: list[int], most: list[int], seats: int) -> list[int]:
    """Seats for one source's shards, a seat at a time to the highest quotient, none above its limit; ties to the earlier shard."""
    total = sum(values)
    if not total or seats <= 0:
        return [0] * len(values)
    given = [min(m, max(0, int(v * seats // total) - len(values) // 2 - 1)) for v, m in zip(values, most)]
    heap = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(values, given, most)) if v and g < m]
    heapq.heapify(heap)
    for _ in range(seats - sum(given)):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-values[i] / (2 * given[i] + 1), i))
    return given


def whole_target(words: list[int], most: list[int], goal: int) -> list[int]:
    """``words`` of a source's shards, changed by as little as makes them add up to ``goal``, none above its limit."""
    made, left = list(words), goal - sum(words)
    for i in sorted(range(len(made)), key=lambda i: (-most[i], i)):
        change = max(-made[i], min(left, most[i] - made[i]))
        made[i] += change
        left -= change
    return made


def shard_words(shards: DataFrame, block: int, most: int = MOST_REPEATS) -> DataFrame:
    """``words`` that each shard of a source takes. Shards have about ``SHARD_BLOCKS`` blocks, so a source has a few thousand at most."""
    def rows(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        sizes, seats, goal = table.column("shard_size").to_pylist(), table.column("seats")[0].as_py(), table.column("goal")[0].as_py()
        limits = [most * s for s in sizes]
        quotas = highest_quotients(sizes, [-(-m // block) for m in limits], seats)
        words = whole_target([min(q * block, m) for q, m in zip(quotas, limits)], limits, goal)
        return table.select(["gone", "name", "shard", "shard_size"]).append_column("words", pa.array(words, pa.int64()))

    return shards.groupBy("gone", "name").applyInArrow(rows, "gone boolean, name string, shard long, shard_size long, words long")


def overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    return F.greatest(F.lit(0), F.least(b, d) - F.greatest(a, c))


def mix(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = MOST_REPEATS, blocks: int = BLOCKS, seed: int = 17,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``. Sources' weights repeat ``cycle`` in order of their names."""
    sized = sized_documents(docs, seed, id_column, text_column, source_column)
    aimed = stored(targets(sized.groupBy("gone", "name").agg(F.sum("size").alias("size")), cycle, most), "targets")
    total = aimed.agg(F.sum("size")).first()[0] or 0
    block = max(1, min(-(-total // blocks), LARGEST_BLOCK))
    seated = apportion(aimed, F.col("target"), round(total / block), ["gone", "name"])
    seated = stored(seated.select(F.col("gone").alias("_gone"), F.col("name").alias("_name"), F.col("size").alias("source_size"), "target", "seats",
                                  F.floor(F.col("target") + 0.5).alias("goal"), F.greatest(F.lit(1), F.floor(F.col("size") / (block * SHARD_BLOCKS))).alias("n")), "seats")
    known = (F.col("gone") == F.col("_gone")) & (F.col("name") == F.col("_name"))
    dealt = stored(sized.join(seated, known).withColumn("shard", F.pmod("spot", "n")).drop("_gone", "_name", "spot", "n"), "dealt")
    shards = dealt.groupBy("gone", "name", "shard").agg(F.sum("size").alias("shard_size"), F.first("seats").alias("seats"), F.first("goal").alias("goal"))

    ring = W.partitionBy("gone", "name", "shard").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(ring)).withColumn("start", F.col("end") - F.col("size"))
    words = F.col("words")
    length = F.greatest(F.col("shard_size"), F.lit(1))
    rounds = F.floor(words / length)
    rest = words - rounds * length
    first = F.pmod(F.xxhash64(F.lit(seed + 2), "name", "shard"), F.greatest(F.lit(1), F.floor(length / block))) * block
    taken = rounds * F.col("size") + overlap(F.col("start"), F.col("end"), first, F.least(first + rest, length)) + overlap(
        F.col("start"), F.col("end"), F.lit(0), F.greatest(F.lit(0), first + rest - length))
    return placed.join(shard_words(shards, block, most), ["gone", "name", "shard"]).select(
        "doc_id", F.when(~F.col("gone"), F.col("name")).alias("source"), "size", "source_size", "target", taken.cast("long").alias("taken"))
