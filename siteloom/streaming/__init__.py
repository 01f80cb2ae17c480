"""The run as a stream: each micro-batch of the log goes through the same functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import urls
from ..operators import impressions


def hits_by_window(log: DataFrame, ts: str = "ts", late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Hits by address and window of event time; rows later than the watermark are left out."""
    rows = impressions.kept(log).withColumn("url_hash", urls.url_key(urls.clean(F.col("trimmed_page_url"))))
    return rows.withWatermark(ts, late).groupBy(F.window(ts, width).alias("window"), "url_hash").agg(F.count(F.lit(1)).alias("hits"))


def each_batch(log: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs step on every micro-batch that is there, then stops; a batch is repeated after a failure."""
    return log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
