import datetime

import pytest
from pyspark.sql import functions as F

from crawlweave.functions.jsonrules import is_date_time, is_uri
from crawlweave.operators.enrich import classify, enrich_messages, priority_tasks
from crawlweave.operators.gates import origin_cap, robots_gate, robots_rules, status_triage
from crawlweave.operators.routing import due_retries, route_outcomes, run_step
from crawlweave.operators.validate import parse_results, validate_enriched, validate_results, validate_tasks
from crawlweave.options import TOPIC_DLQ, TOPIC_ENRICHED
from crawlweave.sources.lake import raw_lake_rows
from crawlweave.sources.tables import pages_table, products_table
from crawlweave.sources.topics import read_topics, to_task_messages, write_topics
from crawlweave.streaming.collect import collect_documents
from crawlweave.streaming.enrich import enrich_batch


TASK_RULES = [
    ('{"url":"http://a.b/c","depth":0}', None, []),
    ('{"url":"http://a.b/c","depth":1.0,"priority":"high"}', None, []),
    ('{"url":"http://a.b/c","depth":1e2}', None, []),
    ('{bad', "json", ["document:json"]),
    ("", "json", ["document:json"]),
    ("5", "schema", ["document:type"]),
    ("null", "schema", ["document:type"]),
    ('[{"url":1}]', "schema", ["document:type"]),
    ("{}", "schema", ["url:required", "depth:required"]),
    ('{"url":5,"depth":"1","priority":3,"x":1}', "schema",
     ["url:type", "depth:type", "priority:type", "priority:enum", "x:unknown"]),
    ('{"url":null,"depth":null}', "schema", ["url:type", "depth:type"]),
    ('{"url":"not a uri","depth":-1.5}', "schema", ["url:format", "depth:type", "depth:minimum"]),
    ('{"url":"http://a.b/ü","depth":1}', "schema", ["url:format"]),
    ('{"url":"http://a.b/c","depth":true}', "schema", ["depth:type"]),
    ('{"url":"http://a.b/c","depth":[1]}', "schema", ["depth:type"]),
]


def test_task_rules(spark):
    rows = spark.createDataFrame([(i, case[0]) for i, case in enumerate(TASK_RULES)], "i int, value string")
    for row in validate_tasks(rows).collect():
        value, reason, violations = TASK_RULES[row["i"]]
        assert (row["reason"], row["violations"]) == (reason, violations), value
        assert row["outcome"] == ("dlq" if reason else "ok") and (row["url"] is None) == bool(reason)


GOOD = ('{"sitesUrl":"http://a.b/","title":null,"body":null,"html":"","more":1,"meta":{"fetchedAt":"2024-02-29T10:00:00Z",'
        '"domain":"a.b","selector_mode":"ai","contentHash":"c","aiConfidence":1,"odd":[1]}}')


RESULT_RULES = [
    ("", "", []),
    ('"title":null', '"title":7', ["title:type"]),
    ('"html":""', '"html":null', ["html:type"]),
    ('"body":null', '"body":{"children":{}}', ["body.children:type"]),
    ("2024-02-29", "2023-02-29", ["meta.fetchedAt:format"]),
    ('"domain":"a.b",', "", ["meta.domain:required"]),
    ('"aiConfidence":1', '"aiConfidence":"high"', ["meta.aiConfidence:type"]),
    ('"more":1', '"detectedType":null', ["detectedType:type", "detectedType:enum"]),
    ('"more":1', '"detectedType":"auction"', ["detectedType:enum"]),
]


def test_result_rules(spark):
    rows = [(i, GOOD.replace(old, new) if old else GOOD) for i, (old, new, _) in enumerate(RESULT_RULES)]
    frame = spark.createDataFrame(rows, "i int, value string")
    strict = {r["i"]: r["violations"] for r in validate_enriched(frame).collect()}
    plain = {r["i"]: r["violations"] for r in validate_results(frame).collect()}
    for i, (old, new, violations) in enumerate(RESULT_RULES):
        assert strict[i] == violations, new
        assert plain[i] == [v for v in violations if not v.startswith("detectedType")], new


DATE_TIME = [
    ("2024-01-01T00:00:00Z", True), ("2024-01-01t00:00:00.5+01:00", True), ("2024-01-01 00:00:00z", True),
    ("2024-01-01T00:00:00", False), ("2024-01-01", False), ("2024-13-01T00:00:00Z", False), ("2024-04-31T00:00:00Z", False),
    ("1900-02-29T00:00:00Z", False), ("2000-02-29T00:00:00Z", True), ("2024-01-01T24:00:00Z", False),
    ("2016-12-31T23:59:60Z", True), ("2016-12-31T18:59:60-05:00", True), ("2016-12-31T22:59:60Z", False), ("yesterday", False)]


def test_date_time(spark):
    rows = spark.createDataFrame(DATE_TIME, "t string, good boolean").select("t", "good", is_date_time(F.col("t")).alias("got"))
    assert [r["t"] for r in rows.collect() if r["got"] != r["good"]] == []


URI = [
    ("http://a.b/c?d=e#f", True), ("urn:a:b", True), ("mailto:x@y.z", True), ("http://[::1]:80/", True), ("a/b", False),
    ("http://a b/", False), ("http://a/%zz", False), ("//a/b", False), ("http://a/{x}", False), ("1http://a", False)]


def test_uri(spark):
    rows = spark.createDataFrame(URI, "t string, good boolean").select("t", "good", is_uri(F.col("t")).alias("got"))
    assert [r["t"] for r in rows.collect() if r["got"] != r["good"]] == []


def test_routing_table(spark):
    rows = [(None, "retry"), ("1", "retry"), ("2", "retry"), ("9", "retry"), ("4", "dlq"), ("1", "ok"), ("x", "dlq")]
    log = spark.createDataFrame(rows, "a string, outcome string").withColumn(
        "headers", F.when(F.col("a").isNotNull(), F.create_map(F.lit("attempts"), F.col("a"))))
    got = sorted((r["a"] or "", r["topic"], r["headers"]["attempts"]) for r in route_outcomes(log).collect())
    assert got == [("", "crawl.initial.retry.30s", "1"), ("1", "crawl.initial.retry.30s", "2"), ("2", "crawl.initial.retry.5m", "3"),
                   ("4", "crawl.initial.dlq", "5"), ("9", "crawl.initial.retry.5m", "10"), ("x", "crawl.initial.dlq", "1")]
    last = {r["a"]: r["topic"] for r in route_outcomes(log, max_attempts=3).collect()}
    assert last["2"] == last["9"] == "crawl.initial.dlq" and last["1"] == "crawl.initial.retry.30s"


def test_unknown_outcome_fails(spark):
    rows = spark.createDataFrame([("maybe",)], "outcome string")
    with pytest.raises(Exception, match="unknown outcome"):
        run_step(rows, lambda r: r).collect()


def test_due_retries(spark):
    rows = [("crawl.initial.retry.30s", 0), ("crawl.initial.retry.30s", 31), ("crawl.initial.retry.5m", 0), ("crawl.initial", 0)]
    log = spark.createDataFrame(rows, "topic string, s int").withColumn("timestamp", F.timestamp_seconds("s"))
    due = due_retries(log, F.timestamp_seconds(F.lit(60)))
    assert [(r["topic"], r["s"]) for r in due.collect()] == [("crawl.initial.retry.30s", 0)]


def test_robots(spark):
    body = ("User-agent: a\nUser-agent: *\nDisallow: /private # no\nAllow: /private/ok\n\nDisallow: /*.pdf$\nSitemap: x\n"
            "User-agent: b\nDisallow: /\nDisallow:")
    robots = spark.createDataFrame([("https://ex.com", body), ("https://n.com", None)], "origin string, body string")
    rules = robots_rules(robots)
    assert sorted((r["agent"], r["allow"], r["pattern"]) for r in rules.collect() if r["agent"] != "a") == [
        ("*", False, "/*.pdf$"), ("*", False, "/private"), ("*", True, "/private/ok"), ("b", False, "/")]
    urls = ["https://ex.com/", "https://ex.com/private", "https://ex.com/private/ok/1", "https://ex.com/a.pdf",
            "https://ex.com/a.pdf?x", "https://n.com/private", "https://other.com/private", "bad url"]
    tasks = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = {r["url"] for r in robots_gate(tasks, rules).collect()}
    assert kept == set(urls) - {"https://ex.com/private", "https://ex.com/a.pdf"}
    assert {r["url"] for r in robots_gate(tasks, rules, agent="b").collect()} == {
        u for u in urls if not u.startswith("https://ex.com")}


def test_robots_tie_goes_to_allow(spark):
    rules = robots_rules(spark.createDataFrame([("https://ex.com", "User-agent: *\nDisallow: /a\nAllow: /a")], "origin string, body string"))
    assert robots_gate(spark.createDataFrame([("https://ex.com/a",)], "url string"), rules).count() == 1


def test_origin_cap_with_one_hot_origin(spark):
    rows = [(i, "https://hot.com" if i % 3 else f"https://h{i % 50}.com", "high" if i % 100 == 1 else "normal") for i in range(3000)]
    tasks = spark.createDataFrame(rows, "seq int, origin string, priority string").repartition(8)
    got = origin_cap(tasks).collect()
    assert len(got) == 3000
    admitted = sorted((r["origin"], r["seq"]) for r in got if r["outcome"] == "ok")
    expected = []
    for origin in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == origin), key=lambda r: (r[2] != "high", r[0]))[:4]
        expected += [(origin, r[0]) for r in mine]
    assert admitted == sorted(expected)


def test_status_triage(spark):
    rows = [(200, 0), (399, 2), (404, 0), (429, 0), (500, 1), (503, 2)]
    got = status_triage(spark.createDataFrame(rows, "status int, attempt int")).collect()
    assert [(r["outcome"], r["wait_ms"]) for r in got] == [
        ("ok", None), ("ok", None), ("fail", None), ("retry", 1000), ("retry", 2000), ("fail", None)]


DEFAULT_RULE = [
    ("https://h.com/da/123", "product"), ("https://h.com/da/123?x=1", "product"), ("https://h.com/123", "product"),
    ("https://h.com/p?x=/a/12", "product"), ("https://h.com/AUKTION/x", "product"), ("https://h.com/da/123/", "page"),
    ("https://h.com/da/123#t", "page"), (None, "page")]


def test_default_rule(spark):
    for row in classify(spark.createDataFrame(DEFAULT_RULE, "url string, want string")).collect():
        assert (row["label"], row["confidence"]) == (row["want"], 0.85 if row["want"] == "product" else 0.6), row["url"]


def test_missing_label_fails(spark):
    rows = spark.createDataFrame([("https://h.com/",)], "url string")
    silent = lambda url, text: F.struct(F.lit(None).cast("string").alias("label"), F.lit(1.0).alias("confidence"))
    with pytest.raises(Exception, match="without label"):
        classify(rows, silent).collect()


def test_malformed_results_do_not_stop_a_batch(spark, tmp_path):
    columns = "topic string, key string, value string, timestamp timestamp, partition int, offset long"
    moment = datetime.datetime(2024, 1, 1)
    bad = ["{bad", "[1]", ""]
    messages = spark.createDataFrame([("results.db", "k", v, moment, 0, n) for n, v in enumerate([GOOD, *bad])], columns)
    enrich_batch(messages, f"{tmp_path}/log", "b0")
    written = spark.read.parquet(f"{tmp_path}/log").collect()
    assert sorted(r["value"] for r in written if r["topic"] == TOPIC_DLQ) == sorted(bad)
    assert sum(r["topic"] == TOPIC_ENRICHED for r in written) == 1
    assert raw_lake_rows(messages).select("value").collect() == [(GOOD,)]
    pages, products = pages_table(spark, f"{tmp_path}/pages"), products_table(spark, f"{tmp_path}/products")
    for batch in ("b0", "b1"):
        collect_documents(messages, pages, products, batch)
    assert pages.read().count() == 1


def test_enrichment_keeps_unknown_keys(spark):
    row = enrich_messages(spark.createDataFrame([(GOOD,)], "value string")).first()
    doc = __import__("json").loads(row["value"])
    assert doc["more"] == 1 and doc["meta"]["odd"] == [1] and doc["title"] is None
    assert doc["detectedType"] == "page" and doc["meta"]["aiConfidence"] == 0.6
    parsed = parse_results(spark.createDataFrame([(row["value"],)], "value string"), enriched=True)
    assert parsed.selectExpr("to_json(extra) AS e").first()["e"] == '{"more":1}'


def test_priority_tasks(spark):
    labelled = classify(spark.createDataFrame([("https://h.com/1",), ("https://h.com/x",)], "url string"))
    assert [tuple(r) for r in priority_tasks(labelled).collect()] == [
        ("crawl.priority", "https://h.com", '{"url":"https://h.com/1","depth":0,"priority":"high"}')]


def test_topic_folder(spark, tmp_path):
    tasks = spark.createDataFrame([("https://h.com/a", 0, None), ("https://h.com/b", 1, "high")], "url string, depth int, priority string")
    messages = to_task_messages(tasks, "crawl.initial").union(spark.createDataFrame([("crawl.initial", "k", None)], "topic string, key string, value string"))
    for _ in range(2):
        write_topics(messages, str(tmp_path / "log"), "one")
    read = read_topics(spark, str(tmp_path / "log"), ["crawl.initial"])
    assert sorted(r["value"] for r in read.collect()) == [
        '{"url":"https://h.com/a","depth":0}', '{"url":"https://h.com/b","depth":1,"priority":"high"}']
    assert read_topics(spark, str(tmp_path / "log"), ["crawl.priority"]).count() == 0
