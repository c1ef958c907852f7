"""Official totals in, tables, crops, manifest and report out."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OFFICIAL = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("as_of", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("contests", T.MapType(T.StringType(), T.StructType([T.StructField("writein_total", T.LongType())]))),
])


def official_totals(spark: SparkSession, path: str | None) -> DataFrame:
    """party, official, and source, as_of, status of the document; empty without a file."""
    if path is None:
        return spark.createDataFrame([], "party string, official long, source string, as_of string, status string")
    return contests(spark.read.schema(OFFICIAL).json(path, multiLine=True))


def contests(documents: DataFrame) -> DataFrame:
    """The totals of official documents (OFFICIAL), a row for each party."""
    totals = documents.select("source", "as_of", "status", F.explode("contests").alias("party", "t"))
    return totals.select("party", F.col("t.writein_total").alias("official"), "source", "as_of", "status")


def write_tables(results: DataFrame, review: DataFrame, folder: str) -> None:
    """results and review_queue as Parquet and CSV."""
    for name, table in (("results", results), ("review_queue", review)):
        table.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        table.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")


def write_crops(crops: DataFrame) -> None:
    """crop_path, content: each crop to its path, from the executors; paths are on a file system that they share."""

    def save(rows) -> None:
        import os

        for row in rows:
            os.makedirs(os.path.dirname(row["crop_path"]), exist_ok=True)
            with open(row["crop_path"], "wb") as f:
                f.write(row["content"])

    crops.select("crop_path", "content").foreachPartition(save)


def manifest_document(summary: dict, validation: dict, top_names: list[str], tally: Iterable[dict], gallery: dict[str, list[dict]]) -> Iterator[str]:
    """The document in pieces, the tally name by name: it has a row for each name and is not held whole."""
    text = lambda value: json.dumps(value, indent=1, ensure_ascii=False)
    head = {"summary": summary, "validation": validation, "top_folded": ", ".join(top_names)}
    yield "{\n" + "".join(f"{text(k)}: {text(v)},\n" for k, v in head.items()) + '"candidate_tally": ['
    for i, row in enumerate(tally):
        yield (",\n" if i else "\n") + json.dumps(row, ensure_ascii=False)
    yield f'\n],\n"gallery": {text(gallery)}\n}}\n'
