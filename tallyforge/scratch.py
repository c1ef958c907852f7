"""Tables written on the way: stored as Parquet in the shared folder and read back.

They cut lineage and survive a lost executor, and what they hold (row numbers, results of Python workers)
is worked out once, however often it is read.  The folder is the one that the session names in
``spark.checkpoint.dir``.  Loops ``discard`` the tables of earlier rounds; ``clean`` deletes the rest once no
result is read any more.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where the session names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """``df`` stored once in the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    _written.append(path)
    return out


def held() -> list[str]:
    """The folders that are not deleted yet, in the order of their writing."""
    return list(_written)


def delete(spark: SparkSession, path: str) -> None:
    if path in _written:
        _written.remove(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Deletes the files of frames from ``written`` that nothing reads any more."""
    for frame in frames:
        delete(frame.sparkSession, frame._stored)


def clean(spark: SparkSession) -> None:
    """Deletes all that ``written`` has stored; for the end of a session, when no result is read any more."""
    for path in held():
        delete(spark, path)
