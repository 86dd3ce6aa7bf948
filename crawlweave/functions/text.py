"""Text, time and address expressions as plain Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space of the reference's language, wider than Java's \s.
WHITESPACE_CLASS = "[\\t-\\r\\x20\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, F.lit(WHITESPACE_CLASS + "+"), F.lit(" ")))


def content_hash(text: Column) -> Column:
    """SHA-256 of the cleaned text; a missing text hashes like an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def prefix_fingerprint(text: Column) -> Column:
    """First 16 hex digits of SHA-1 over the first 5000 characters (the field called ``simhash``)."""
    return F.substring(F.sha1(F.substring(F.coalesce(text, F.lit("")), 1, 5000)), 1, 16)


def iso_time(ts: Column) -> Column:
    """UTC instant as text with milliseconds and a Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_iso_time(text: Column) -> Column:
    return F.try_to_timestamp(text)


def lake_domain(hostname: Column) -> Column:
    return F.regexp_replace(hostname, "[^a-zA-Z0-9.-]", "_")


def lake_stamp(ts: Column) -> Column:
    """File stamp of the raw lake: ISO time with ':' and '.' replaced."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH-mm-ss-SSS'Z'")


def product_id(url: Column, pattern: str) -> Column:
    """Digits at the end of a product address, null for other addresses."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def product_slug(url: Column) -> Column:
    """Second last non-empty path part before the query."""
    path = F.substring_index(url, "?", 1)
    return F.nullif(F.regexp_extract(path, r"(?s)([^/]+)/+[^/]+/*\z", 1), F.lit(""))


def first_text(body: Column) -> Column:
    """Text of the first body child; null when there is none."""
    return F.get(body["children"], F.lit(0))["text"]


def order_key(ts: Column, tie: Column) -> Column:
    """Time and tie-break as one number, which a hash aggregate can update in place (a struct it cannot)."""
    return (F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)")
            + tie.cast("decimal(19,0)")).cast("decimal(38,0)")
