"""Addresses: cleaning, keys, hosts, reasons to leave them out, and the address to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Results depend on them.
PLACEHOLDERS = ("(not set)", "none", "null", "")
RESERVED = ("test", "local", "localhost", "invalid", "example")
LOCAL = r"\.local(\.|$)"
INTERNAL_SUFFIX = r"\.local\.simpleviewcms\.com$|\.cms30\.localhost$"
INTERNAL_PATTERN = r"\.staging\.simpleviewcms\.com$|(^|\.)primary[\d-]*-.*\.simpleviewcms\.com$"
IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
PORT = r":\d+$"


def clean(text: Column) -> Column:
    return F.trim(F.lower(text))


def url_key(url: Column) -> Column:
    return F.sha2(url.cast("string"), 256)


def first_label(address: Column) -> Column:
    """What stands before the first slash, without a scheme."""
    return F.split_part(F.regexp_replace(F.coalesce(address, F.lit("")), "^https?://", ""), F.lit("/"), F.lit(1))


def with_host(df: DataFrame) -> DataFrame:
    """Adds netloc, host and tld; the site's host stands in where the address has none."""
    own = first_label(F.col("trimmed_page_url"))
    df = df.withColumn("netloc", F.when(own.rlike("[.:]"), own).otherwise(first_label(F.col("site"))))
    df = df.withColumn("host", F.regexp_replace("netloc", r"^www\.", ""))
    return df.withColumn("tld", F.regexp_extract("host", r"\.([^.]+)$", 1))


def drop_reason() -> Column:
    """Why a host isn't public, the first reason that holds; null for public ones."""
    host, netloc = F.col("host"), F.col("netloc")
    rules = [
        ("reserved_or_local", F.col("tld").isin(*RESERVED) | host.rlike(LOCAL)), ("internal_suffix", host.rlike(INTERNAL_SUFFIX)),
        ("internal_pattern", host.rlike(INTERNAL_PATTERN)), ("single_label_host", ~host.contains(".")), ("ipv4_literal", host.rlike(IPV4)),
        ("explicit_port", netloc.rlike(PORT)), ("underscore_in_host", host.contains("_")),
    ]
    return F.coalesce(*(F.when(holds, F.lit(name)) for name, holds in rules))


def page_url() -> Column:
    u = F.col("trimmed_page_url")
    return (F.when(u.startswith("http"), u).when(u.startswith("//"), F.concat(F.lit("https:"), u))
            .when(u.startswith("/"), F.concat(F.lit("https://"), F.col("host"), u)).otherwise(F.concat(F.lit("https://"), u)))


def classify_hosts(df: DataFrame) -> DataFrame:
    """Cleaned rows without placeholders, with host columns and drop_reason."""
    df = df.withColumns({c: clean(F.col(c)) for c in ("trimmed_page_url", "site")})
    df = df.where(~F.col("trimmed_page_url").isin(*PLACEHOLDERS) & ~F.col("site").isin(*PLACEHOLDERS))
    return with_host(df).withColumn("drop_reason", drop_reason())


def transform(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows with page_url and url_hash, rejected rows), two filters over one plan."""
    seen = classify_hosts(df)
    valid = seen.where("drop_reason is null").withColumn("page_url", page_url())
    if "url_hash" not in valid.columns:
        valid = valid.withColumn("url_hash", url_key(F.col("trimmed_page_url")))
    return valid, seen.where("drop_reason is not null").select("site", "trimmed_page_url", "host", "drop_reason")


def is_homepage(url: Column, site: Column) -> Column:
    """Whether an address, less trailing slashes, is the site's, less any "www."; false if either is missing."""
    same = F.rtrim(F.lower(F.trim(url)), F.lit("/")) == F.replace(F.lower(F.trim(site)), F.lit("www."), F.lit(""))
    return F.coalesce((url != "") & (site != "") & same, F.lit(False))


def not_public(url: Column) -> Column:
    """Whether an address isn't to be opened: no host, a reserved end, or an internal suffix."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce((host == "") | F.substring_index(host, ".", -1).isin(*RESERVED) | host.rlike(INTERNAL_SUFFIX), F.lit(True))
