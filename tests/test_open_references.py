"""Texts against their SQL where character references lack their semicolon."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from siteloom.functions import pages
from siteloom.plans import catalog

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Small tables with references in every page that are cut off, as at the end of a title."""
    made = tmp_path_factory.mktemp("open")
    for f in os.listdir(DATA):
        if f != "pages.parquet":
            os.symlink(f"{DATA}/{f}", made / f)
    cut = "replace(html, '</title>', ' &amp;&amp</title>&lt;a&quot<p>&nbsp</p>&copy 2020 &#39 &#39; &amp;lt')"
    duckdb.sql(f"COPY (SELECT page_id, url, {cut} AS html FROM '{DATA}/pages.parquet') TO '{made}/pages.parquet'")
    return str(made)


@pytest.mark.parametrize("name", ["batch_scan_text", "visible_text"])
def test_same_rows(spark, folder, name):
    df = catalog.QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{f}'")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert any("&amp" in r[1] for r in want)
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_the_parser_s_rule_stays_the_default(spark):
    df = spark.createDataFrame([("<html>a &amp<p>&copy 2020 &#39</p></html>",)], "b string")
    assert df.select(pages.visible_text(F.col("b")), pages.visible_text(F.col("b"), closed=True)).first()[:] == ("a & © 2020 '", "a &amp &copy 2020 &#39")
