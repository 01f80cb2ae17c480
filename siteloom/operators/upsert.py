"""Upserts by join: what MERGE statements do, as a new snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RESULT_COLUMNS, STAGED_COLUMNS


def upsert(target: DataFrame, source: DataFrame, keys: list[str], updates: dict[str, Column], inserts: dict[str, Column] | None = None, several: bool = False) -> DataFrame:
    """target after a merge of source; in the expressions `t.` is a target row before it and `s.` a source row.

    Without inserts unmatched source rows are left out. Null keys match nothing. A target row that several source
    rows match is an error, raised when the rows are read; with several it comes once for each of them instead.
    Source rows are counted where the join brings them anyway.
    """
    s = source.withColumn("_s", F.lit(1) if several else F.count(F.lit(1)).over(Window.partitionBy(*keys))).alias("s")
    t = target.withColumn("_t", F.lit(True)).alias("t")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    joined = t.join(s, on, "full_outer" if inserts else "left")
    both = F.col("_t").isNotNull() & F.col("_s").isNotNull()
    if not several:
        repeated = F.raise_error(F.lit(f"several source rows match a target row by {', '.join(keys)}")).cast("boolean")
        joined = joined.where(F.when(both & (F.col("_s") > 1), repeated).otherwise(F.lit(True)))
    def value(c: str) -> Column:
        kept = F.when(both, updates[c]).otherwise(F.col(f"t.{c}")) if c in updates else F.col(f"t.{c}")
        return F.when(F.col("_t").isNull(), inserts.get(c, F.lit(None))).otherwise(kept) if inserts else kept
    return joined.select(*(value(c).alias(c) for c in target.columns))


def with_times(rows: DataFrame) -> DataFrame:
    """rows with created_at and last_accessed as timestamps; what can't be read as one is null."""
    return rows.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in ("created_at", "last_accessed")})


def touch(results: DataFrame, touches: DataFrame, now: Column, bump_counts: bool = False) -> DataFrame:
    """Sets last_accessed of touched keys; with bump_counts also adds their dup_hits to view_count."""
    updates = {"last_accessed": now}
    if bump_counts:
        updates["view_count"] = F.col("t.view_count") + F.col("s.dup_hits")
    return upsert(results, touches, ["url_hash"], updates)


def stage(staged: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates by run and key: hits of known ones are replaced, new ones inserted."""
    return upsert(staged, candidates, ["run_id", "url_hash"], {"access_hits": F.col("s.access_hits")}, {c: F.col(f"s.{c}") for c in STAGED_COLUMNS})


def attach_text(staged: DataFrame, texts: DataFrame, several: bool = False) -> DataFrame:
    """Sets the text of staged rows; with several, an address that has more than one gives a row for each."""
    return upsert(staged, texts, ["batch_id", "url_hash"], {"page_text": F.col("s.page_text")}, several=several)


def loadable(rows: DataFrame) -> DataFrame:
    """Rows with a topic and a confidence that is a number."""
    return rows.where(F.col("content_topic").isNotNull() & F.col("prediction_confidence").isNotNull() & ~F.isnan("prediction_confidence"))


def best_confidence(results: DataFrame, rows: DataFrame, now: Column, several: bool = False) -> DataFrame:
    """Keeps the answer of higher confidence by key; a tie keeps what is there, new keys come in.

    With several, each answer for a key that is there gives a row of its own.
    """
    better = F.col("s.prediction_confidence") > F.col("t.prediction_confidence")
    pick = lambda c: F.when(better, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    updates = {c: pick(c) for c in ("content_topic", "review_flag", "nlp_raw_categories", "business_category")}
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    updates |= {"prediction_confidence": F.greatest(zero("t.prediction_confidence"), zero("s.prediction_confidence")), "last_accessed": now}
    return upsert(results, loadable(rows), ["url_hash"], updates, {c: F.col(f"s.{c}") for c in RESULT_COLUMNS} | {"last_accessed": now}, several)


def reconcile(results: DataFrame, hits: DataFrame, now: Column) -> DataFrame:
    """Sets view_count to the lifetime hits of the keys given."""
    return upsert(results, hits, ["url_hash"], {"view_count": F.col("s.lifetime_hits"), "last_accessed": now})
