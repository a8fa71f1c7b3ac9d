"""Shared pieces of the text operators: table access, Arrow batches, UTF-8 offsets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import fresh_path

#: White space as a character class; every run of anything else is a word.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smallest_hashes(df: DataFrame, text: str, count: int) -> DataFrame:
    """Rows (text, hash) of the ``count`` distinct texts of smallest hashes, copies included.

    Only hashes are sorted; the texts are picked by comparison where they are
    read.  Without rows the result is empty.
    """
    rows = df.select(F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    last = rows.select("hash").distinct().orderBy("hash").limit(count).agg(F.max("hash")).first()[0]
    return rows.where(F.lit(False) if last is None else F.col("hash") <= last)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def word_count(text: Column) -> Column:
    """How many words a text has, without keeping them."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK)
    outer = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return (F.size(parts) - outer).cast("long")


def whole(df: DataFrame) -> Column:
    """All columns of a row in one struct, so that working columns can't clash with them."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns]).alias("_whole")


def parts(df: DataFrame) -> list[Column]:
    """The columns of ``df`` out of the struct again."""
    return [F.col("_whole").getField(c).alias(c) for c in df.columns]


def batch_sizes(spark: SparkSession) -> None:
    """Cut Arrow batches by rows and bytes, so that long texts don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def arrow_rows(
    df: DataFrame,
    inputs: list[str],
    work: Callable[..., Iterator[tuple] | list[tuple]],
    schema: T.StructType,
    setup: Callable[[], object] | None = None,
) -> DataFrame:
    """Run ``work`` on lists of the input columns, batch by batch.

    ``work(state, *columns)`` returns one list per output column.  ``setup``
    makes the state once per task.  Batches are cut by bytes as well as rows,
    so very long texts don't pile up in a worker.
    """
    batch_sizes(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            columns = work(state, *[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(columns, fields, strict=True)], schema=fields
            )

    return df.select(*inputs).mapInArrow(run, schema)


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (a finalizer with public constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
