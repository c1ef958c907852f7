"""New scans as a stream: each file is taken in once, whatever restarts happen between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..operators.state import insert_if_absent
from ..sources.scan import manifest


def new_files(spark: SparkSession, root: str, cfg: Config) -> DataFrame:
    """path of files as they appear; contents are never read."""
    columns = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(columns).option("pathGlobFilter", "*.[jJ][pP]*[gG]").load(f"{root}/{cfg.filename.box_prefix}*")
    return stream.select("path")


def watch(spark: SparkSession, root: str, table: str, checkpoint: str, cfg: Config, every: str | None = "60 seconds") -> StreamingQuery:
    """Appends manifest rows to the Parquet table; ``every`` None takes in what is there and stops.

    The checkpoint's file log hands each path over once.  A batch that is replayed after a crash is
    joined against the table first, so it adds no row twice.
    """

    def add(batch: DataFrame, _: int) -> None:
        rows = manifest(batch, cfg)
        session = batch.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table)
        there = path.getFileSystem(session._jsc.hadoopConfiguration()).exists(path)
        if there:
            rows = insert_if_absent(session.read.parquet(table), rows, "path")[1]
        rows.write.mode("append").parquet(table)

    writer = new_files(spark, root, cfg).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
