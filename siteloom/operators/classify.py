"""From page text to classified rows, with an injected classifier."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pages, topics, urls
from ..schemas import CATEGORIES, RESULT_COLUMNS

#: Seconds of one call, of all attempts together, and between them: the first, the growth and the longest.
CALL, DEADLINE, FIRST, GROWTH, LONGEST = 30.0, 60.0, 1.0, 1.5, 10.0
#: Calls don't start in step: each waits up to so many seconds first.
APART = 0.05


class Busy(Exception):
    """The classifier is out of quota, away or late; another attempt may do."""


class RateLimiter:
    """Calls at most `rps` times a second in a task, each interval up to `jitter` longer or shorter."""

    def __init__(self, rps: float = 5.0, jitter: float = 0.1, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        if rps <= 0:
            raise ValueError("rps is above 0")
        self.interval, self.jitter, self.clock, self.wait, self.next = 1 / rps, jitter, clock, wait, 0.0

    def acquire(self) -> None:
        now = self.clock()
        if now < self.next:
            self.wait(self.next - now)
        self.next = max(now, self.next) + self.interval * random.uniform(1 - self.jitter, 1 + self.jitter)


def answer(text: str, classifier: Callable[[str, float], list[dict] | None], clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep) -> list[dict] | None:
    """Categories of a text; None for no answer, which isn't the same as an empty one.

    The classifier gets the text and the seconds that it may take. Busy is tried again until DEADLINE, anything else
    that it raises ends the call.
    """
    end, pause = clock() + DEADLINE, FIRST
    wait(random.uniform(0, APART))
    while True:
        try:
            return classifier(text, min(CALL, max(0.0, end - clock())))
        except Busy:
            if clock() + pause > end:
                return None
            wait(random.uniform(0, pause))
            pause = min(pause * GROWTH, LONGEST)
        except Exception:  # noqa: BLE001  a failed call drops its row, not the run
            return None


def remote(rows: DataFrame, classifier: Callable[[str, float], list[dict] | None], rps: float = 5.0) -> DataFrame:
    """rows with `categories` from a classifier called once for each text that is long enough; others have null."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = RateLimiter(rps)

        def one(text: str):
            limiter.acquire()
            return answer(text, classifier)

        for part in parts:
            yield part.drop(columns="_long").assign(categories=[one(t) if long else None for t, long in zip(part["page_text"], part["_long"], strict=True)])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    long = F.coalesce(pages.word_count(F.col("page_text")) >= topics.LEAST_WORDS, F.lit(False))
    return rows.withColumn("_long", long).mapInPandas(run, f"{kinds}, categories {CATEGORIES}")


def enough_words(rows: DataFrame, least: int = topics.LEAST_WORDS) -> DataFrame:
    return rows.where(pages.word_count(F.col("page_text")) >= least)


def classified(rows: DataFrame, now: Column) -> DataFrame:
    """Result rows of texts long enough that have categories; the first category counts.

    rows has the staged columns, page_text and categories. A missing key is made from the address.
    """
    first = F.try_element_at("categories", F.lit(1))
    rows = enough_words(rows).where(F.size("categories") > 0)
    topic, sure = first["name"], first["confidence"]
    home = urls.is_homepage(F.col("trimmed_page_url"), F.col("site"))
    made = {
        "url_hash": F.coalesce("url_hash", urls.url_key(F.col("trimmed_page_url"))), "created_at": now, "business_category": F.when(home, F.lit(topics.HOME)).otherwise(topics.map_topic(topic)),
        "content_topic": topic, "prediction_confidence": sure, "review_flag": sure < topics.REVIEW_BELOW, "nlp_raw_categories": topics.render(F.col("categories")),
        "last_accessed": now, "view_count": topics.view_count(F.col("access_hits")),
    }
    return rows.select(*(made.get(c, F.col(c)).alias(c) for c in RESULT_COLUMNS))


def summary(rows: DataFrame) -> DataFrame:
    """One row of counts over classified rows."""
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("url_hash").alias("n_hashes"), F.count("content_topic").alias("n_topics"), F.count("business_category").alias("n_categories"),
        F.count("prediction_confidence").alias("n_confidences"), F.round(F.avg("prediction_confidence"), 6).alias("avg_confidence"), F.sum(F.col("review_flag").cast("int")).alias("n_review"), F.sum("view_count").alias("views"),
    )
