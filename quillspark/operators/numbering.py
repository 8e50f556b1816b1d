"""Row numbers within groups that stay parallel when one group holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rank_in_groups(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], bucket: Column,
                   name: str, total: str | None = None) -> DataFrame:
    """Add ``name``, the 1-based place of each row in its group, and ``total``, the size of the group.

    ``bucket`` must never fall along ``order``. Rows are numbered inside (group, bucket) and shifted by the
    number of rows in earlier buckets, so the sort of a large group is spread over its buckets.
    """
    tagged = df.withColumn("_bucket", bucket)
    sizes = tagged.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    in_group = W.partitionBy(*groups)
    before = in_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"),
        F.sum("_n").over(in_group).alias("_total"))
    local = F.row_number().over(W.partitionBy(*groups, "_bucket").orderBy(*order))
    match = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(groups):
        match = match & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = tagged.withColumn("_place", local).join(shifts, match)
    extra = [F.col("_total").alias(total)] if total else []
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).cast("long").alias(name), *extra)


def hash_order(seed: int, key: str) -> Column:
    """A hexadecimal pseudo-random order that is the same on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def hash_bucket(order: Column, digits: int = 3) -> Column:
    """Leading digits of :func:`hash_order`; more digits for larger groups."""
    return F.substring(order, 1, digits)
