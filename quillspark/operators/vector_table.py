"""The vector table: rows ``(id, document, embedding, metadata)`` with add, update, delete and search."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..session import small_side
from . import nearest

SCHEMA = ("id string, document string, embedding array<float>, "
          "metadata struct<source: string, page: int, original_text: string>")
PARTS = ("document", "embedding", "metadata")


def one_per_id(rows: DataFrame) -> DataFrame:
    """Keep one row per id, the smallest by its other columns in their order."""
    rest = [c for c in rows.columns if c != "id"]
    picked = rows.groupBy("id").agg(F.min(F.struct(*rest)).alias("r"))
    return picked.select("id", *[F.col(f"r.{c}").alias(c) for c in rest])


def add(current: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``current`` plus the new ids; an id already present is left as it is."""
    return current.unionByName(fresh(current, new))


def fresh(current: DataFrame, new: DataFrame, unique: bool = False) -> DataFrame:
    return (new if unique else one_per_id(new)).join(current.select("id"), "id", "left_anti")


def delete(current: DataFrame, ids: DataFrame) -> DataFrame:
    """``current`` without the given ids; unknown ids are ignored."""
    return current.join(small_side(ids.select("id")), "id", "left_anti")


def update(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace only the parts that ``changes`` has a column and a value for; unknown ids are ignored.

    Changed rows can be long, so the join carries no hint.
    """
    parts = [c for c in PARTS if c in changes.columns]
    marked = changes.select("id", *[F.col(c).alias(f"_{c}") for c in parts])
    joined = current.join(marked, "id", "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in parts else F.col(c) for c in current.columns])


def metadata_keys(where: dict, columns: list[str]) -> dict:
    """Keys that are no column of the table name a field of its metadata."""
    found = {}
    for key, want in where.items():
        if key in ("$and", "$or"):
            found[key] = [metadata_keys(w, columns) for w in want]
        else:
            found[key if key.split(".")[0] in columns or "metadata" not in columns else f"metadata.{key}"] = want
    return found


def search(current: DataFrame, queries: DataFrame, k: int = V.TOP_K, metric: str = "l2",
           where: dict | None = None, cells: bool | None = None) -> DataFrame:
    """The ``k`` nearest rows for each ``(id, vector)`` query; ``where`` filters before the ranking.

    A key names a column or a field of the metadata. Rows whose value is null match no condition, ``$ne`` and ``$nin`` included.
    """
    rows = current.filter(nearest.where_clause(metadata_keys(where, current.columns))) if where else current
    return nearest.top_k(queries, rows.select("id", F.col("embedding").alias("vector")), k, metric, cells=cells)


class VectorTable:
    """A stored vector table in any folder Spark can write to.

    Adding appends files. Update and delete write the next version beside the old one; a version exists once it
    is listed in ``versions``, so a failed write leaves the table as it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str = SCHEMA):
        self.spark, self.path, self.schema = spark, path, schema

    def _version(self) -> int | None:
        try:
            listed = self.spark.read.schema("version long").parquet(os.path.join(self.path, "versions"))
            return listed.agg(F.max("version")).head()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _data(self, version: int) -> str:
        return os.path.join(self.path, f"data-{version}")

    def exists(self) -> bool:
        return self._version() is not None

    def rows(self) -> DataFrame:
        version = self._version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._data(version))

    def _publish(self, rows: DataFrame) -> None:
        version = (self._version() or 0) + 1
        rows.write.mode("overwrite").parquet(self._data(version))
        listed = self.spark.range(1).select(F.lit(version).cast("long").alias("version"))
        listed.write.mode("append").parquet(os.path.join(self.path, "versions"))

    def add(self, new: DataFrame, unique: bool = False) -> None:
        """Add the rows whose id is new; ``unique`` says that no id comes twice in ``new``."""
        version = self._version()
        if version is None:
            self._publish(new if unique else one_per_id(new))
        else:
            fresh(self.rows(), new, unique).write.mode("append").parquet(self._data(version))

    def delete(self, ids: DataFrame) -> None:
        self._publish(delete(self.rows(), ids))

    def update(self, changes: DataFrame) -> None:
        self._publish(update(self.rows(), changes))

    def count(self) -> int:
        return self.rows().count()

    def search(self, queries: DataFrame, k: int = V.TOP_K, metric: str = "l2", where: dict | None = None, cells: bool | None = None) -> DataFrame:
        return search(self.rows(), queries, k, metric, where, cells)
