"""Sources: parquet tables and the impression log derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import urls

#: The impression log as a view over events and pages; the same text runs in Spark SQL and DuckDB.
IMPRESSIONS_SQL = """
WITH j AS (
  SELECT e.event_id AS event_id, e.user_id AS user_id, CAST(e.ts AS DATE) AS date, p.url AS url,
         regexp_replace(p.url, '^https?://', '') AS bare,
         split_part(regexp_replace(p.url, '^https?://', ''), '/', 1) AS h
  FROM (SELECT ev.*, (ev.event_id * 7) % pc.n AS pid FROM events ev CROSS JOIN (SELECT count(*) AS n FROM pages) pc) e
  JOIN pages p ON p.page_id = e.pid
)
SELECT event_id, date,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN '(Not Set)'
       WHEN event_id % 47 = 0 THEN 'nodots' ELSE concat(' ', upper(h)) END AS site,
  CASE event_id % 32
    WHEN 0 THEN NULL WHEN 1 THEN '(not set)' WHEN 2 THEN ' NULL ' WHEN 3 THEN ''
    WHEN 4 THEN 'x.local.simpleviewcms.com/a' WHEN 5 THEN 'a.cms30.localhost/b'
    WHEN 6 THEN 'city.staging.simpleviewcms.com/c' WHEN 7 THEN 'primary-12-foo.simpleviewcms.com/d'
    WHEN 8 THEN 'localhost:8080/e' WHEN 9 THEN '10.0.0.1/f' WHEN 10 THEN '10.0.0.1:80/g'
    WHEN 11 THEN 'foo_bar.com/h' WHEN 12 THEN 'foo.test/i'
    WHEN 13 THEN concat('//cdn.', h, '/x') WHEN 14 THEN concat('/', split_part(bare, '/', 2)) WHEN 15 THEN 'page'
    WHEN 16 THEN 'httpbin.org/x' WHEN 17 THEN upper(url) WHEN 18 THEN concat(h, '/') WHEN 19 THEN h
    WHEN 20 THEN replace(h, 'www.', '')
    ELSE bare END AS trimmed_page_url,
  CASE WHEN user_id % 50 = 49 THEN NULL WHEN user_id % 10 = 3 THEN concat('Demo ', CAST(user_id AS VARCHAR(20)))
       WHEN user_id % 10 = 4 THEN concat('demo ', CAST(user_id AS VARCHAR(20)))
       ELSE concat('client_', CAST(user_id AS VARCHAR(20))) END AS client_id
FROM j
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The impression log: event_id, date, site, trimmed_page_url, client_id."""
    return spark.sql(IMPRESSIONS_SQL.replace("FROM events ev", "FROM {events} ev").replace("FROM pages)", "FROM {pages})").replace("JOIN pages p", "JOIN {pages} p"), events=table(spark, sf_dir, "events"), pages=table(spark, sf_dir, "pages"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bodies by address: page_id, url_hash, html."""
    bare = urls.clean(F.regexp_replace("url", "^https?://", ""))
    return table(spark, sf_dir, "pages").select("page_id", urls.url_key(bare).alias("url_hash"), bare.alias("bare"), "html")


def rows_of(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """In-memory rows with a declared schema."""
    return spark.createDataFrame(rows, schema)


def existing(spark: SparkSession, name: str) -> DataFrame:
    """The result table if the catalog has it, else an empty one of its schema."""
    return spark.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schemas.RESULT)


def partition(staged: DataFrame, batch_id: str, with_text: bool = False) -> DataFrame:
    """The rows of one batch; only those that have a text, if asked."""
    got = staged.where(F.col("batch_id") == batch_id)
    return got.where("page_text is not null") if with_text else got


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at; which ones isn't defined."""
    return df.limit(rows)
