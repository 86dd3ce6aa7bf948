"""Links of a page that stay on its site."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.functions.urls import normalize_address, parse_url


@F.arrow_udf(T.ArrayType(T.StringType()))
def site_links(urls: pa.Array, links: pa.Array) -> pa.Array:
    """Distinct normalized links of each page that stay on its origin."""
    known: dict[str, tuple] = {}

    def look(text: str) -> tuple:
        if text not in known:
            found = parse_url(text)
            known[text] = (found.origin, normalize_address(found)) if found else (None, None)
        return known[text]

    def keep(page: str, targets) -> list[str]:
        origin = look(page)[0]
        pairs = map(look, targets or ())
        return list(dict.fromkeys(link for site, link in pairs if origin and site == origin))

    return pa.array([keep(page, targets) for page, targets in zip(urls.to_pylist(), links.to_pylist())],
                    pa.list_(pa.string()))


def same_origin_links(pages: DataFrame) -> DataFrame:
    """``(url, links, …)`` -> one row per page and distinct normalized ``link`` of the same origin.

    Filtering and the distinct happen per page before the explode: no shuffle, and dropped links never become rows.
    """
    kept = [c for c in pages.columns if c != "links"]
    return pages.select(*kept, F.explode(site_links("url", "links")).alias("link"))
