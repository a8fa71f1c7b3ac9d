"""Session settings, the shared working folder and staged tables.

A staged table is a Parquet copy of an intermediate result (cleaned sales, the
star tables, the panel).  Reports read the copy, so the cost of building it is
paid once, its lineage ends there, and a lost executor re-reads files instead
of re-running the whole job.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on any cluster size; partition counts and memory are left
# to the cluster, adaptive execution sizes the shuffles.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(name: str = "tidemark", **settings: str) -> SparkSession:
    """A session with the engine's SQL settings plus the caller's own."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else made."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is missing a temporary folder is made, which is only
    right when driver and executors are the same machine.
    """
    context = spark.sparkContext
    named = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_fingerprints: dict[tuple[str, str], str] | None = None


@contextmanager
def one_query() -> Iterator[None]:
    """Inside, the fingerprint of a folder is taken once; elsewhere each time it is asked for."""
    global _fingerprints
    _fingerprints = {}
    try:
        yield
    finally:
        _fingerprints = None


def fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, lengths and modification times of all files below a folder.

    Any file system that Spark reads will do.  A staged table or a fitted model
    that was made from other files is not used again.
    """
    known = {} if _fingerprints is None else _fingerprints
    key = (spark.sparkContext.applicationId, folder)
    if key not in known:
        top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files, lines = system.listFiles(top, True), []
        while files.hasNext():
            f = files.next()
            lines.append(f"{f.getPath().toUri().getPath()} {f.getLen()} {f.getModificationTime()}")
        known[key] = hashlib.md5("\n".join(sorted(lines)).encode()).hexdigest()
    return known[key]


def exists(spark: SparkSession, path: str) -> bool:
    """Is there such a file or folder, in any file system that Spark reads?"""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


_staged: dict[tuple[str, str, str], str] = {}


def staged(
    spark: SparkSession,
    source: str,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Read the staged table ``name`` for ``source``, writing it on first use."""
    key = (spark.sparkContext.applicationId, f"{source}#{fingerprint(spark, source)}", name)
    if key not in _staged:
        path = fresh_path(spark, name)
        build().write.partitionBy(*partition_by).parquet(path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])


def is_staged(spark: SparkSession, source: str, name: str) -> bool:
    """Has the staged table ``name`` been written for ``source`` in this session?"""
    return (spark.sparkContext.applicationId, f"{source}#{fingerprint(spark, source)}", name) in _staged


def measured(df: DataFrame, label: str) -> DataFrame:
    """Write an aggregate and read it back, so that its true size is known.

    The size estimate of an aggregate is its input's, which would make Spark
    shuffle the other join side; from files it sees the real size and
    broadcasts only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
