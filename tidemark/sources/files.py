"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import to_date_or_null


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True
) -> DataFrame:
    """Scan CSV with a fixed schema; a field that does not fit becomes null."""
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path, header=header)
    )


def read_csv_dates(
    spark: SparkSession, path: str, schema: T.StructType, dates: Sequence[str]
) -> DataFrame:
    """Scan CSV and parse ``dates`` one by one, so a bad date costs only itself."""
    kinds = [T.StructField(f.name, T.StringType() if f.name in dates else f.dataType) for f in schema]
    raw = read_csv(spark, path, T.StructType(kinds))
    return raw.withColumns({name: to_date_or_null(F.col(name)) for name in dates})


def bootstrap_schema(spark: SparkSession, path: str, share: float = 0.01) -> T.StructType:
    """Infer a schema once from a share of a file, to be reviewed and then fixed."""
    return spark.read.option("samplingRatio", share).csv(path, header=True, inferSchema=True).schema


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One header per part file, no index column."""
    df.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def inline_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """A small literal table with a declared schema (``"name string, n int"``)."""
    return spark.createDataFrame(list(rows), columns)


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text over named DataFrames, ``{name}`` standing for each of them."""
    return spark.sql(text, **tables)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str, folder: str) -> DataFrame:
    """Keep a table in ``buckets`` buckets of its keys, sorted by them, under a name of the catalog.

    A join or an aggregate on the keys needs no shuffle of such a table.  The files
    lie in ``folder``; the catalog only knows the name and the buckets.  About
    one bucket per 128 MB and task is right, so that none outgrows a task.
    """
    (
        df.write.format("parquet").mode("overwrite").option("path", folder)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)
