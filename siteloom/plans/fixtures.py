"""What stands for the network in the catalog: answers by page, some of them missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CATEGORIES

MISSING = "[SKIP:404]"
#: Names that the stand-in classifier gives, in turn.
NAMES = ("/Travel/Air Travel", "/Sports/Team Sports", "/Sports", "/News/Weather", "/Health/Aging", "/Food & Drink/Restaurants", "/Travel & Transportation/Transportation/Air Travel", "/Arts & Entertainment/Events & Listings/Film")


def answers(bodies: DataFrame) -> DataFrame:
    """Stored bodies of which every 19th page is missing."""
    return bodies.withColumn("html", F.when(F.col("page_id") % 19 == 0, F.lit(MISSING)).otherwise(F.col("html")))


def stand_in(page_id: Column) -> Column:
    """Deterministic categories by page: null for every 17th, none for every 13th, else one or two."""
    name = lambda k: F.element_at(F.array(*(F.lit(n) for n in NAMES)), (page_id + k).cast("int") % len(NAMES) + 1)
    sure = lambda k: ((page_id * 37 + k) % 101) / F.lit(100.0)
    one = lambda k: F.struct(name(k).alias("name"), sure(k).alias("confidence"))
    none = F.array().cast(CATEGORIES)
    return F.when(page_id.isNull() | (page_id % 17 == 0), F.lit(None).cast(CATEGORIES)).when(page_id % 13 == 0, none).when(page_id % 2 == 0, F.array(one(0), one(3))).otherwise(F.array(one(0)))


def classified(rows: DataFrame) -> DataFrame:
    return rows.withColumn("categories", stand_in(F.col("page_id")))
