"""Fetched bodies: what kind they are, what to do about a response, and the visible text."""

from __future__ import annotations

import gzip
import html.entities
import json
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Results depend on them.
HTML_MARKS = ("<html", "<!doctype html", "<head", "<body")
SNIFFED = 4096
BLOCKED = (
    "access denied", "request blocked", "forbidden", "permission denied", "captcha", "verify you are human",
    "attention required", "cloudflare", "akamai", "incapsula", "perimeterx", "sucuri",
)
BLOCKED_BELOW = 10_000
MAGIC = ("255044462D", "504B0304", "89504E470D0A1A0A", "FFD8FF", "52494646")
GZIP_MAGIC = b"\x1f\x8b"
LARGEST, READ_AHEAD, SAMPLE = 5 * 1024 * 1024, 1024, 64
#: White space as str.strip() and str.split() know it, for Java's and RE2's expressions alike.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: What has no text in it: comments, and elements with all that is in them; an open one goes to the end.
UNSEEN = r"(?is)<!--.*?(?:--!?>|\z)|" + "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "noscript"))
TAG = r"(?s)<(?:/?[A-Za-z]|[!?])[^>]*>"
BREAK = "\x01"


def is_html(body: Column) -> Column:
    start = F.lower(F.substring(body, 1, SNIFFED))
    return F.coalesce(start.rlike("|".join(HTML_MARKS)), F.lit(False))


def unescaped(text: Column, closed: bool = False) -> Column:
    """text with its character references replaced: named ones, decimal and hexadecimal numbers.

    Names are those of the standard library's table; without a semicolon only the old ones count. With closed,
    neither names nor numbers count without one.
    """
    names = F.from_json(F.lit(json.dumps(html.entities.html5)), "map<string,string>")
    end = ";" if closed else ";?"
    # Numbers that stand for the signs of an old code page.
    odd = F.create_map(*(x for n in range(128, 160) if (sign := bytes([n]).decode("cp1252", "ignore")) for x in (F.lit(n), F.lit(sign))))

    def sign(number: Column) -> Column:
        known = number.isNotNull() & (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        code = F.decode(F.unhex(F.lpad(F.hex(F.when(known, number).otherwise(0xFFFD).cast("long")), 8, "0")), "UTF-32")
        return F.coalesce(F.try_element_at(odd, number.cast("int")), code)

    def piece(x: Column) -> Column:
        name = F.regexp_extract(x, f"^(#[0-9]+{end}|#[xX][0-9A-Fa-f]+{end}|[A-Za-z][A-Za-z0-9]*{end})", 1)
        digits = F.regexp_extract(name, r"^#([0-9]+)", 1).try_cast("bigint")
        hexadecimal = F.regexp_extract(name, r"^#[xX]0*([0-9A-Fa-f]{1,8});?$", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10).try_cast("bigint")).otherwise(digits)
        known = F.when(name.startswith("#"), sign(number)).when(name != "", F.try_element_at(names, name))
        return F.coalesce(F.concat(known, F.substr(x, F.length(name) + 1)), F.concat(F.lit("&"), x))

    parts = F.split(text, "&", -1)
    whole = F.array_join(F.concat(F.slice(parts, 1, 1), F.transform(F.slice(parts, 2, 1 << 30), piece)), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def visible_text(body: Column, closed: bool = False) -> Column:
    """Text nodes outside script, style and noscript, stripped and joined by a space; empty for what isn't HTML.

    closed as in unescaped: False is what an HTML parser does, True what the catalog's SQL says.
    """
    nodes = F.split(F.regexp_replace(F.regexp_replace(body, UNSEEN, BREAK), TAG, BREAK), BREAK)
    text = F.array_join(F.filter(F.transform(nodes, lambda x: F.regexp_replace(unescaped(x, closed), f"^{SPACE}+|{SPACE}+$", "")), lambda x: x != ""), " ")
    return F.when(is_html(body) & ~body.startswith("[ERROR"), text).otherwise("")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda x: x != ""))


def is_blocked(sample: Column, length: Column) -> Column:
    return (length < BLOCKED_BELOW) | F.lower(sample).rlike("|".join(BLOCKED))


def http_action(status: Column, attempt: Column, retries: int = 2) -> Column:
    """body, skip, retry or fall_through for a response status at an attempt counted from 0."""
    retry = F.when(attempt < retries, "retry").otherwise("fall_through")
    return F.when(status.isin(401, 404, 410), "skip").when(status.between(200, 299), "body").when((status.isin(403, 429)) | status.between(500, 599), retry).otherwise("skip")


def backoff_bounds(attempt: Column, base: float = 0.75) -> Column:
    """The least and most seconds before another attempt."""
    mid = F.lit(base) * F.pow(F.lit(2.0), attempt)
    return F.struct((mid * 0.5).alias("low"), (mid * 1.5).alias("high"))


def retry_after(header: Column, now: Column) -> Column:
    """Seconds that a Retry-After header asks for: a number, or a date's distance from now, 0 at least; else null."""
    at = F.try_to_timestamp(F.regexp_replace(header, "^[A-Za-z]+, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    left = F.unix_timestamp(at) - F.unix_timestamp(now)
    return F.coalesce(header.try_cast("double"), F.when(left.isNotNull(), F.greatest(left.cast("double"), F.lit(0.0))))


def looks_binary(data: Column) -> Column:
    """Whether bytes start with a known file mark or hold a control byte among the first ones."""
    start = F.hex(F.substring(data, 1, SAMPLE))
    known = F.lit(False)
    for mark in MAGIC:
        known = known | start.startswith(mark)
    return F.coalesce(known | start.rlike(r"^(?:..)*(?:0[0-8BCEF]|1.)"), F.lit(False))


def _decoded(raw: bytes | None) -> str:
    def binary(b: bytes) -> bool:
        return b[:SAMPLE].hex().upper().startswith(MAGIC) or any(c < 9 or c in (11, 12) or 14 <= c < 32 for c in b[:SAMPLE])
    raw = (raw or b"")[: LARGEST + READ_AHEAD]
    if not raw or binary(raw):
        return ""
    for unpack in (gzip.decompress, lambda b: zlib.decompress(b, wbits=zlib.MAX_WBITS | 32)):
        try:
            raw = unpack(raw)
            break
        except Exception:  # noqa: BLE001  not packed in this way
            continue
    return "" if binary(raw) else raw[:LARGEST].decode("utf-8", "replace")


@F.pandas_udf(StringType())
def decoded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bytes as text: binary ones empty, packed ones unpacked, UTF-8 with replacement, at most LARGEST bytes."""
    for part in parts:
        yield part.map(_decoded)
