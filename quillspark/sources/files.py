"""Reading and writing reviews as CSV, page scans, incremental ingest and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed_values as V
from ..functions.text import base_name, strip_markup

REVIEW_SCHEMA = "row_id LONG, reviewText STRING, overall DOUBLE"


def read_csv(spark: SparkSession, path: str, schema: str, missing: list[str] = V.CSV_MISSING, multi_line: bool = True) -> DataFrame:
    """CSV with a header; every string in ``missing`` reads as null.

    With ``multi_line`` values may hold quoted line breaks, and a file is one split: write many files (see :func:`write_csv`). Without it large
    files are split, and a line with an open quote stops the read.
    """
    wanted = T.StructType.fromDDL(schema)
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted.fields])
    rows = (spark.read.schema(raw).option("header", True).option("multiLine", multi_line).option("mode", "PERMISSIVE" if multi_line else "FAILFAST")
            .option("quote", '"').option("escape", '"').option("nullValue", "").csv(path))

    def typed(field: T.StructField) -> Column:
        text = F.col(f"`{field.name}`")
        known = F.when(text.isin(missing), F.lit(None)).otherwise(text)
        return known.cast(field.dataType).alias(field.name)

    return rows.select(*[typed(f) for f in wanted.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no row index; arrays, maps and structs are written as JSON."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields]
    (df.select(*flat).write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("escapeQuotes", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def scan_pages(pages: DataFrame, path: str = "url", markup: str = "html") -> DataFrame:
    """Text of each stored page with its base file name; pages without text are dropped."""
    return pages.select("page_id", base_name(F.col(path)).alias("source"),
                        strip_markup(F.col(markup)).alias("text")).filter(F.col("text") != "")


def not_ingested(incoming: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    return incoming.join(manifest.select(key), key, "left_anti")


def split_rejects(rows: DataFrame, checks: list[tuple[Column, str]]) -> DataFrame:
    """Add ``reason``: the first failed check, null for a good row. Failed rows never stop the run."""
    reason = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in checks])
    return rows.withColumn("reason", reason)
