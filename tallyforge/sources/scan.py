"""Listing scanned pages under a root of box folders, one level deep."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import Config
from ..functions.text import file_name, parse_name

# Endings of files still being copied.
UNFINISHED = (".part", ".tmp", ".crdownload", ".download")


def wanted(name):
    """Whether a file name is that of a finished scan."""
    low = F.lower(name)
    unfinished = F.lit(False)
    for ending in UNFINISHED:
        unfinished |= low.endswith(ending)
    return ~name.startswith(".") & ~unfinished & low.rlike(r"\.jpe?g$")


def manifest(paths: DataFrame, cfg: Config) -> DataFrame:
    """path -> the image table's rows of parsable scans, status pending."""
    name = file_name(F.col("path"))
    box_folder = F.element_at(F.split("path", "/"), -2)
    rows = paths.filter(wanted(name) & box_folder.startswith(cfg.filename.box_prefix)).withColumn("_p", parse_name(F.col("path"), cfg.filename))
    rows = rows.filter(F.col("_p.box").isNotNull()).select(
        "path", F.col("_p.box").alias("box"), F.col("_p.seq").alias("seq"), F.lit(S.PENDING).alias("status"),
        (F.unix_micros(F.current_timestamp()) / 1e6).alias("updated_at"),
    )
    return S.conformed(rows, S.IMAGES)


def skipped(paths: DataFrame, cfg: Config) -> DataFrame:
    """n: finished scans whose name does not parse."""
    name = file_name(F.col("path"))
    return paths.filter(wanted(name)).agg(F.count_if(parse_name(F.col("path"), cfg.filename)["box"].isNull()).alias("n"))


def list_files(spark: SparkSession, root: str, cfg: Config) -> DataFrame:
    """path of each file in the box folders; contents are pruned, so no bytes are read.

    Files without a byte are not listed: they are scans still to come.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[jJ][pP]*[gG]").load(f"{root}/{cfg.filename.box_prefix}*")
    return files.select("path")


def list_boxes(spark: SparkSession, root: str, cfg: Config) -> DataFrame | None:
    """box of each box folder, also of those without a finished scan yet; None if the root cannot be read.

    This is what coverage compares with: a box that is still being copied is missing, not unknown.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    try:
        entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    except Py4JJavaError:
        return None
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    return spark.createDataFrame([(n,) for n in names if n.startswith(cfg.filename.box_prefix)], "box string")


def boxes_on_disk(paths: DataFrame) -> DataFrame:
    """box of the listed files; boxes without a finished scan are not among them (see ``list_boxes``)."""
    return paths.select(F.element_at(F.split("path", "/"), -2).alias("box")).distinct()
