import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from crawlweave.functions import html
from crawlweave.functions.html import parse_selectors, read_page
from crawlweave.functions.text import collapse_whitespace
from crawlweave.operators.extract import extract_pages, page_results, result_json


@pytest.mark.parametrize("html, title, text, links", [
    ("", None, "", []),
    ("<title> \n </title>", None, "", []),
    ("<title> A &amp; B </title><title>C</title>x", "A & B", "x", []),
    ("<body><p>a</p><p>b</p></body>", None, "ab", []),
    ("<body>a<!-- c --><script>x</script></body>", None, "ax", []),
    ("<head><script>var t='</p>';</script></head><body>b", None, "b", []),
    ("<body>a&nbsp;&nbsp;b &amp c</body>", None, "a b & c", []),
    ("<body>a　﻿ b c", None, "a b c", []),
    ("x < y <3 > z", None, "x < y <3 > z", []),
    ("<body>a</body> b", None, "a b", []),
    ("<textarea>&lt;b&gt;</textarea><a href='?a=1&copy=2&amp;b'>l</a>", None, "<b>l", ["?a=1&copy=2&b"]),
    ("<a href=x>1</a><a name=y>2</a><A HREF=\"z\" href=w>3</A>", None, "123", ["x", "z"]),
    ("a<script>open", None, "aopen", []),
    ("a<!-- open", None, "a", []),
    ("a<p title=\"x>y\">b<br/>c", None, "abc", []),
])
def test_read_page(html, title, text, links):  # noqa: F811
    assert read_page(html) == (title, text, links)


@pytest.mark.parametrize("html, selectors, text, links", [
    ("<div class='ad x'>one</div><h1>two <a href=q>3</a></h1>", ".ad, h1", "one two 3", ["q"]),
    ("<h1>t</h1><div class=ad>u</div>", ".ad,,h1 ", "u t", []),
    ("<ul class=m><li>1<li>2</ul><li>3", "ul.m li", "1 2", []),
    ("<div class=a><div class=a>x</div></div>", ".a", "x x", []),
    ("<p>a<div>b</div><p id=k>c", "p", "a c", []),
    ("<p>a<p id=k>c", "p#k", "c", []),
    ("<a href=x id=me>t<b>u</b></a>", "#me", "tu", []),
    ("<p>a", "h1", "", []),
])
def test_selectors(html, selectors, text, links):
    assert read_page(html, parse_selectors(selectors))[1:] == (text, links)


@pytest.mark.parametrize("text", ["a > b", "a:hover", "[href]", "a+b"])
def test_other_selectors_are_refused(text):
    with pytest.raises(ValueError):
        parse_selectors(text)


def test_extract_and_result(spark):
    rows = [("https://www.Ex.com/a", "<title>T</title><a href='/b'>hi</a>", "2024-01-01 00:00:00"),
            ("https://ex.com/e", "", "2024-01-01 00:00:00"), ("https://ex.com/n", None, "2024-01-01 00:00:00")]
    pages = spark.createDataFrame(rows, "url string, html string, at string").withColumn("fetched_at", F.col("at").cast("timestamp"))
    found = extract_pages(pages)
    got = {r["url"]: r for r in found.collect()}
    assert got["https://www.Ex.com/a"]["links"] == ["https://www.ex.com/b"]
    assert got["https://ex.com/e"]["content_hash"] == hashlib.sha256(b"").hexdigest()
    assert got["https://ex.com/n"]["text"] is None
    results = page_results(found.filter("text is not null"))
    lines = {r["sitesUrl"]: r["v"] for r in results.select("sitesUrl", result_json(results).alias("v")).collect()}
    assert '"body":null' in lines["https://ex.com/e"] and '"html":""' in lines["https://ex.com/e"]
    meta = {r["sitesUrl"]: r["meta"] for r in results.collect()}["https://www.Ex.com/a"]
    assert (meta["domain"], meta["fetchedAt"], meta["selector_mode"]) == ("www.ex.com", "2024-01-01T00:00:00.000Z", "ai")
    assert meta["simhash"] == hashlib.sha1(b"hi").hexdigest()[:16]


def test_html_is_kept_only_with_selectors(spark):
    pages = spark.createDataFrame([("https://ex.com/a", "<h1>x</h1>y", None)], "url string, html string, fetched_at timestamp")
    found = extract_pages(pages, "h1", keep_html=True)
    row = page_results(found, selectors="h1").first()
    assert row["html"] == "<h1>x</h1>y" and row["meta"]["selector_mode"] == "css"
    assert row["body"]["children"][0]["text"] == "x"


def test_collapse_whitespace_column(spark):
    row = spark.createDataFrame([(" a \n b﻿",)], "t string").select(collapse_whitespace(F.col("t")).alias("t")).first()
    assert row["t"] == "a b"


class _NoRun:
    def match(self, text, at):
        return re.compile("").match(text, at)


def test_long_runs_agree_with_tag_by_tag_reading(monkeypatch):
    rng = random.Random(1)
    pieces = ["<p>", "</p>", '<b x="<a href=q>">', "<a href=u>", "</a>", "<!-- c -->", "<br/>", "text", "&amp;", "&am", "p;", "<",
              "<3", "</>", "<script>", "</script>", "<title>", "</title>", '<A HREF="v">', "<abbr>", "<p a='", '"', ">", "<body>",
              "<head>", "</", "<!x>", "<textarea>", "</textarea>", " ", "&lt", "<template>", "</template>", "<a", "<titlex>"]
    pages = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    quick = [read_page(page) for page in pages]
    monkeypatch.setattr(html, "_RUN", _NoRun())
    assert [read_page(page) for page in pages] == quick
