"""Batches of a fixed size in the order of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan(n: int, size: int, cap: int) -> tuple[int, int]:
    """(rows a batch, batches) for n rows; the size grows where there would be more than cap batches."""
    if size < 1 or cap < 1:
        raise ValueError("size and cap are 1 at least")
    if n == 0:
        return size, 0
    if -(-n // size) > cap:
        size = -(-n // cap)
    return size, -(-n // size)


def assign(rows: DataFrame, size: int, run_id: str, digits: int = 3) -> DataFrame:
    """Adds batch_index, run_id and batch_id by the rank of url_hash.

    Keys are uniform hexadecimal digests, so their first digits deal the rows out evenly; a rank is the rows of
    earlier groups plus the place in the own one. No task sees all rows, and the group counts are 16 ** digits.
    """
    rows = rows.withColumn("_group", F.coalesce(F.substring("url_hash", 1, digits), F.lit("")))
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).select("_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_group").orderBy("url_hash"))
    ranked = rows.withColumn("_own", own).join(F.broadcast(counts), "_group")  # 16 ** digits rows at most
    index = F.floor((F.col("_offset") + F.col("_own") - 1) / size).cast("bigint")
    made = ranked.withColumns({"batch_index": index, "run_id": F.lit(run_id)}).drop("_group", "_own", "_offset")
    return made.withColumn("batch_id", F.concat(F.lit("batch_"), F.col("batch_index").cast("string"), F.lit(f"_{run_id}")))
