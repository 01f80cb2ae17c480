"""The impression log: windows, one row an address with its hits, and lifetime hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls


def in_window(start: str | None = None, end: str | None = None) -> Column:
    """Half-open [start, end) if both are given, the day of start alone, no limit otherwise."""
    if start and end:
        return (F.col("date") >= F.lit(start).cast("date")) & (F.col("date") < F.lit(end).cast("date"))
    return F.col("date") == F.lit(start).cast("date") if start else F.lit(True)


def kept(log: DataFrame) -> DataFrame:
    """Rows with an address, a site, and a client that isn't a demo one; a null client goes too."""
    return log.where(F.col("site").isNotNull() & F.col("trimmed_page_url").isNotNull() & ~F.col("client_id").like("%Demo%"))


def dedupe_with_hits(log: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """A row an address of the window: site and client of its least row, the key, and the number of rows.

    Sites that are placeholders come last, so an address keeps a usable site if any of its rows has one. Rows are
    counted by address, site and client first, by hash in each task; only those counts are sorted for the least one.
    """
    base = kept(log.where(in_window(start, end))).select(urls.clean(F.col("site")).alias("site"), urls.clean(F.col("trimmed_page_url")).alias("trimmed_page_url"), "client_id")
    counts = base.groupBy("trimmed_page_url", "site", "client_id").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("site").isin(*urls.PLACEHOLDERS).alias("last"), "site", "client_id")).alias("r")
    made = counts.groupBy("trimmed_page_url").agg(F.sum("n").alias("access_hits"), least)
    return made.select("r.site", "trimmed_page_url", "r.client_id", urls.url_key(F.col("trimmed_page_url")).alias("url_hash"), "access_hits")


def lifetime_hits(log: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Rows of the whole log by key; of some keys only, if given.

    With keys, rows are thinned by a bit map and then joined before they are counted, so the rest of the log isn't
    shuffled.
    """
    rows = kept(log).select(urls.url_key(urls.clean(F.col("trimmed_page_url"))).alias("url_hash"))
    if keys is not None:
        wanted = keys.select("url_hash").where("url_hash is not null").distinct()
        rows = thinned(rows, "url_hash", wanted).join(wanted, "url_hash", "left_semi")
    return rows.groupBy("url_hash").agg(F.count(F.lit(1)).alias("lifetime_hits"))


#: Bits of the map by which rows are thinned out before a join; it is 65,536 rows at most, whatever the input.
MAP_BITS = 1 << 22


def thinned(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """rows without most of those whose key wanted doesn't have; the exact join is still to follow."""
    spot = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    bits = wanted.select(spot.alias("spot")).groupBy(F.expr("spot div 64").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("_bits"))
    marked = rows.withColumn("_spot", spot).withColumn("_word", F.expr("_spot div 64")).join(F.broadcast(bits), "_word")
    return marked.where("shiftrightunsigned(_bits, cast(_spot % 64 as int)) & 1L = 1").drop("_word", "_spot", "_bits")
