"""State changes as plans: the next state of a table is derived from the table and a delta.

Keys are unique in tables and deltas unless an operator says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_if_absent(table: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The table with the rows of new keys, and those rows alone; of rows with one new key, one is taken."""
    added = new.dropDuplicates([key]).join(table.select(key), key, "left_anti").select(*table.columns)
    return table.unionByName(added), added


def update(table: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Columns that the delta has replace the table's where the key is in the delta, nulls included."""
    given = [c for c in delta.columns if c != key]
    d = delta.select(F.col(key), F.lit(True).alias("_given"), *(F.col(c).alias(f"_new_{c}") for c in given))
    joined = table.join(d, key, "left")
    return joined.select(*(F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in table.columns))


def upsert(table: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``update``, and rows for keys that the table lacks; what the delta does not give is null there."""
    given = [c for c in delta.columns if c != key]
    d = delta.select(F.col(key), F.lit(True).alias("_given"), *(F.col(c).alias(f"_new_{c}") for c in given))
    joined = table.join(d, key, "full")
    return joined.select(*(F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in table.columns))


def latest(batches: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key the row of the last batch: upserts of whole rows, folded."""
    by_key = Window.partitionBy(key).orderBy(F.col(order).desc())
    return batches.withColumn("_rank", F.row_number().over(by_key)).filter("_rank = 1").drop("_rank")


def delete(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")


def set_all(table: DataFrame, **values) -> DataFrame:
    return table.withColumns({c: F.lit(v) for c, v in values.items()})


def set_where(table: DataFrame, keys: DataFrame, key: str, **values) -> DataFrame:
    """Columns set on the rows whose key is among ``keys``."""
    flagged = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = table.join(flagged, key, "left")
    return joined.select(*(F.when(F.col("_hit"), F.lit(values[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in table.columns))


def select_status(images: DataFrame, status: str, box: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a status, of one box if given, the first by path if limited."""
    test = F.col("status") == status
    if box is not None:
        test &= F.col("box") == box
    rows = images.filter(test)
    return rows if limit is None else rows.orderBy("path").limit(limit)


def retry_errors(images: DataFrame, status: str) -> DataFrame:
    """Opt-in: rows whose stage failed go back to ``status``."""
    failed = F.col("status") == "error"
    return images.withColumns({"err": F.when(~failed, F.col("err")), "status": F.when(failed, status).otherwise(F.col("status"))})
