import json

import pytest
from pyspark.sql import functions as F

from crawlweave.operators import metrics
from crawlweave.operators.gates import origin_slots
from crawlweave.options import CrawlOptions
from crawlweave.plans import stream_queries
from crawlweave.plans.derived import table, view
from crawlweave.plans.frontier import crawl_frontier
from crawlweave.session import ROCKSDB_PROVIDER
from crawlweave.sources.topics import read_topics, to_task_messages, write_topics
from crawlweave.streaming.dedupe import stream_dedupe_urls, stream_dedupe_within
from crawlweave.streaming.worker import CrawlWorker

PAGES = {
    "https://h.com/0": '<a href="/1">a</a><a href="/2#x">b</a><a href="https://o.com/9">off</a>zero',
    "https://h.com/1": '<a href="/3">c</a>same',
    "https://h.com/2": '<a href="/4">d</a>same',
    "https://h.com/3": '<a href="/0">back</a><a href="/5">e</a>three',
    "https://h.com/5": '<a href="/6">f</a>five',
    "https://h.com/6": "six",
}


@pytest.fixture(scope="module")
def site(spark):
    return spark.createDataFrame(list(PAGES.items()), "url string, html string")


def seeds(spark, *urls, depth=0):
    return spark.createDataFrame([(u, depth) for u in urls], "url string, depth int")


def test_texts_decide_which_page_expands(spark, site, tmp_path):
    """Pages 1 and 2 have texts 'csame' and 'dsame': both are new, so both expand."""
    got = {r["url"][-1]: (r["wave"], r["outcome"]) for r in crawl_frontier(
        spark, seeds(spark, "https://h.com/0", "https://h.com/0"), site, str(tmp_path)).collect()}
    assert got == {"0": (0, "ok"), "1": (1, "ok"), "2": (1, "ok"), "3": (2, "ok"), "4": (2, "retry"), "5": (3, "ok")}


def test_copies_do_not_expand(spark, tmp_path):
    site = spark.createDataFrame([("https://h.com/a", '<a href="/x">same</a>'), ("https://h.com/b", '<a href="/y">same</a>')], "url string, html string")
    got = crawl_frontier(spark, seeds(spark, "https://h.com/a", "https://h.com/b"), site, str(tmp_path)).collect()
    assert {(r["url"][-1], r["fresh"]) for r in got} == {("a", True), ("b", False), ("x", False)}


def test_depth_limit_and_no_tasks(spark, site, tmp_path):
    assert crawl_frontier(spark, seeds(spark, "https://h.com/0"), site, str(tmp_path / "a"), max_depth=1).count() == 3
    assert crawl_frontier(spark, seeds(spark, "https://h.com/0", depth=4), site, str(tmp_path / "b")).count() == 0


def test_a_reused_path_gives_the_waves_of_the_last_call_only(spark, site, tmp_path):
    deep = crawl_frontier(spark, seeds(spark, "https://h.com/0"), site, str(tmp_path), max_depth=3).count()
    assert deep > 1
    assert crawl_frontier(spark, seeds(spark, "https://h.com/0"), site, str(tmp_path), max_depth=0).count() == 1


def test_known_waves_without_content_dedupe(spark, tmp_path):
    """Seeds 0..6 of the derived link graph: 7, 18, 37, 85 known pages."""
    folder = "/root/testdata/sf0.01"
    graph = view(spark, folder, "v_graph_pages")
    tasks = graph.filter("k < 7").select("url", F.lit(0).alias("depth"))
    got = crawl_frontier(spark, tasks, graph.select("url", "html"), str(tmp_path), dedupe_content=False)
    counts = {r["wave"]: r["n"] for r in got.filter("outcome = 'ok'").groupBy("wave").agg(F.count("*").alias("n")).collect()}
    assert counts == {0: 7, 1: 18, 2: 37, 3: 85}
    assert table(spark, folder, "part").count() == graph.count()


def publish(spark, tasks, log, name="seed"):
    write_topics(to_task_messages(tasks, "crawl.initial"), log, name)


def results(spark, log):
    return [json.loads(r["value"]) for r in read_topics(spark, log, ["results.db"]).collect()]


def test_worker_equals_batch_crawl_and_restart_adds_nothing(spark, site, tmp_path):
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    publish(spark, seeds(spark, "https://h.com/0"), log)
    worker = CrawlWorker(spark, log, state, site, CrawlOptions(max_per_origin=None, max_attempts=2))
    worker.drain()
    batch = crawl_frontier(spark, seeds(spark, "https://h.com/0"), site, str(tmp_path / "batch"))
    fresh = {(r["url"], r["content_hash"]) for r in batch.filter("fresh").collect()}
    published = results(spark, log)
    assert {(d["sitesUrl"], d["meta"]["contentHash"]) for d in published} == fresh and len(published) == len(fresh)
    assert read_topics(spark, log, ["results.raw"]).count() == len(fresh)
    dead = read_topics(spark, log, ["crawl.initial.dlq"]).collect()
    assert [(json.loads(r["value"])["url"], r["headers"]["attempts"]) for r in dead] == [("https://h.com/4", "2")]
    log_rows = worker.outcomes()
    assert {(r["mode"], r["queue"], r["n"]) for r in metrics.pages_processed(log_rows).collect()} == {("ai", "kafka", len(fresh))}
    assert {(r["reason"], r["n"]) for r in metrics.pages_failed(log_rows).collect()} == {("extract", 2)}
    assert metrics.links_enqueued(log_rows).first()["n_links"] == 6
    assert CrawlWorker(spark, log, state, site, worker.options).drain() == 0
    publish(spark, seeds(spark, "https://h.com/0", "https://h.com/6"), log, "again")
    worker.drain()
    assert sorted(d["sitesUrl"] for d in results(spark, log)) == sorted({u for u, _ in fresh} | {"https://h.com/6"})


def test_worker_repeated_batch_leaves_one_copy(spark, site, tmp_path):
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    publish(spark, seeds(spark, "https://h.com/0"), log)
    worker = CrawlWorker(spark, log, state, site)
    messages = read_topics(spark, log, ["crawl.initial"])
    messages.write.parquet(str(tmp_path / "in"))
    messages = spark.read.parquet(str(tmp_path / "in"))
    worker.run_batch(messages, 0)
    worker.run_batch(messages, 0)
    assert [d["sitesUrl"] for d in results(spark, log)] == ["https://h.com/0"]
    assert worker.visited().count() == 1


def test_full_origin_waits_and_bad_messages_die(spark, tmp_path):
    site = spark.createDataFrame([(f"https://h.com/{i}", f"page {i}") for i in range(10)], "url string, html string")
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    publish(spark, seeds(spark, *[f"https://h.com/{i}" for i in range(10)]), log)
    write_topics(spark.createDataFrame([("crawl.initial", "k", "{bad"), ("crawl.initial", "k", "{}")], "topic string, key string, value string"), log, "bad")
    worker = CrawlWorker(spark, log, state, site, CrawlOptions(max_per_origin=4))
    assert worker.drain() == 3
    assert len(results(spark, log)) == 10
    assert read_topics(spark, log, ["crawl.initial.dlq"]).count() == 2


def test_one_origin_drains_under_the_default_cap_without_a_round_limit(spark, tmp_path):
    """30 tasks of one origin at 4 a round take 8 rounds, with no round limit to reach."""
    site = spark.createDataFrame([(f"https://h.com/{i}", f"page {i}") for i in range(30)], "url string, html string")
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    publish(spark, seeds(spark, *[f"https://h.com/{i}" for i in range(30)]), log)
    worker = CrawlWorker(spark, log, state, site)
    assert worker.options.max_per_origin == 4 and worker.drain() == 8
    assert len(results(spark, log)) == 30 and worker.visited().count() == 30


def test_tasks_of_a_full_origin_queue_for_its_slots_in_the_batch(spark, tmp_path):
    """Forty tasks of one origin under the default cap: one round, in at most four partitions, high priority first."""
    site = spark.createDataFrame([(f"https://h.com/{i}", f"page {i}") for i in range(40)], "url string, html string")
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    publish(spark, seeds(spark, *[f"https://h.com/{i}" for i in range(40)]), log)
    worker = CrawlWorker(spark, log, state, site, CrawlOptions(queue_in_batch=True))
    assert worker.options.max_per_origin == 4 and worker.drain() == 1
    assert len(results(spark, log)) == 40 and worker.visited().count() == 40
    tasks = spark.createDataFrame([(i, f"https://{'h' if i % 10 else 'o'}.com/{i}", f"https://{'h' if i % 10 else 'o'}.com",
                                    "high" if i % 7 == 0 else None) for i in range(400)],
                                  "seq int, url string, origin string, priority string").repartition(8)
    dealt = origin_slots(tasks).withColumn("place", F.struct(F.spark_partition_id(), F.pmod(F.xxhash64("url"), F.lit(4))))
    rows = dealt.collect()
    assert sorted(r["seq"] for r in rows) == list(range(400))
    for origin in ("https://h.com", "https://o.com"):
        places = {r["place"] for r in rows if r["origin"] == origin}
        assert len({slot for _, slot in places}) == len(places) <= 4
        for place in places:
            turn = [(r["priority"] != "high", r["seq"]) for r in rows if r["origin"] == origin and r["place"] == place]
            assert turn == sorted(turn)


def test_stream_worker_runs_robots_slots_and_retries(spark, small, monkeypatch):
    """The registered query leaves no step of the worker out: a missing page dies after a try from each retry topic."""
    made = []

    class Spy(CrawlWorker):
        def __init__(self, *args, **kwargs):
            super().__init__(*args, **kwargs)
            made.append(self)

    monkeypatch.setattr(stream_queries, "CrawlWorker", Spy)
    assert stream_queries.stream_worker(spark, small).count() > 0
    (worker,) = made
    assert worker.options.max_per_origin == 4 and worker.rules.count() > 0
    dead = read_topics(spark, worker.log, ["crawl.initial.dlq"]).collect()
    assert dead and {r["headers"]["attempts"] for r in dead} == {"4"}
    for topic in ("crawl.initial.retry.30s", "crawl.initial.retry.5m"):
        assert read_topics(spark, worker.log, [topic]).count() >= len(dead)


def test_a_retry_runs_once_after_its_delay(spark, site, tmp_path):
    """A 30 s retry read 10 s after it was published waits (published again with its own time); read 31 s after, it
    runs, once."""
    from datetime import datetime, timedelta, timezone
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    retry = to_task_messages(seeds(spark, "https://h.com/6"), "crawl.initial.retry.30s").withColumn(
        "headers", F.create_map(F.lit("attempts"), F.lit("1")))
    write_topics(retry, log, "seed")
    start = datetime.now(timezone.utc)  # after the message's own time

    def batch(name):
        rows = read_topics(spark, log, ["crawl.initial.retry.30s"]).filter(F.col("batch") == name)
        path = str(tmp_path / f"in-{name}")
        rows.write.parquet(path)
        return spark.read.parquet(path)

    early = CrawlWorker(spark, log, state, site, CrawlOptions(max_attempts=5), clock=lambda: start + timedelta(seconds=10))
    first = batch("seed")
    early.run_batch(first, 0)
    assert results(spark, log) == [] and early.waiting_until is not None
    again = batch("workers-0")
    assert again.count() == 1 and again.first()["timestamp"] == first.first()["timestamp"]
    late = CrawlWorker(spark, log, state, site, CrawlOptions(max_attempts=5), clock=lambda: start + timedelta(seconds=31))
    late.run_batch(again, 1)
    assert [d["sitesUrl"] for d in results(spark, log)] == ["https://h.com/6"] and late.waiting_until is None
    assert read_topics(spark, log, ["crawl.initial.retry.30s"]).count() == 2  # the seed and its one wait, no more


def test_stream_dedupe_with_one_hot_url(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"u{i % 100}") for i in range(600)], "seq int, url string")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for salts in (1, 4):
        run = (stream_dedupe_urls(source, salts=salts).writeStream.format("memory").queryName(f"seen{salts}")
               .option("checkpointLocation", str(tmp_path / f"c{salts}")).trigger(availableNow=True).start())
        run.awaitTermination()
        urls = [r["url"] for r in spark.table(f"seen{salts}").collect()]
        assert len(urls) == len(set(urls)) and set(urls) == {r["url"] for r in rows.collect()}


def test_stream_dedupe_within_delay(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"u{i % 5}") for i in range(50)], "s int, url string").select("url", F.timestamp_seconds("s").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = (stream_dedupe_within(source, "url", "ts", "1 hour").writeStream.format("memory").queryName("within")
           .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    run.awaitTermination()
    assert spark.table("within").count() == 5
