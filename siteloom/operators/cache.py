"""Rows that are classified already, and those that aren't."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def processed_keys(results: DataFrame) -> DataFrame:
    """Keys with a topic; a key without one is tried again."""
    return results.where("content_topic is not null").select("url_hash").distinct()


def with_dup_hits(rows: DataFrame) -> DataFrame:
    """Adds dup_hits, the rows of each key; null for a null key."""
    if "url_hash" not in rows.columns:
        raise ValueError("url_hash is needed; transform computes it")
    return rows.withColumn("dup_hits", F.when(F.col("url_hash").isNotNull(), F.count(F.lit(1)).over(Window.partitionBy("url_hash"))))


def cached(rows: DataFrame, results: DataFrame) -> DataFrame:
    return rows.join(processed_keys(results), "url_hash", "left_semi")


def uncached(rows: DataFrame, results: DataFrame) -> DataFrame:
    return rows.join(processed_keys(results), "url_hash", "left_anti")


def one_a_key(rows: DataFrame) -> DataFrame:
    """The row of each key with the shortest page_url, then the least; null keys count as one."""
    others = [c for c in rows.columns if c != "url_hash"]
    least = F.min(F.struct(F.length("page_url").alias("_length"), F.col("page_url").alias("_url"), *(F.col(c) for c in others))).alias("r")
    return rows.groupBy("url_hash").agg(least).select("url_hash", *(F.col(f"r.{c}").alias(c) for c in others))


def split(rows: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(uncached rows, one a key, and touches: the cached keys with their dup_hits)."""
    counted = with_dup_hits(rows)
    return one_a_key(uncached(counted, results)), cached(counted, results).select("url_hash", "dup_hits").distinct()
