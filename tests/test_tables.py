import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlweave.operators.dedupe import new_content, new_urls
from crawlweave.operators.lookups import latest_by_type, products_lookup, same_content
from crawlweave.options import PRODUCT_URL_REGEX
from crawlweave.functions.text import product_id, product_slug
from crawlweave.schemas import ENRICHED
from crawlweave.sources.lake import lake_rows, lake_write, read_lake
from crawlweave.sources.topics import read_topics, write_topics
from crawlweave.streaming.collect import stream_lake
from crawlweave.sources.tables import (embedding_rows, embeddings_table, page_rows, pages_table, product_rows,
                                       products_table)


PRODUCT_ADDRESS = [
    ("https://h.com/da/123", ("123", "da")), ("https://h.com/da/123?x=1", ("123", "da")),
    ("https://h.com/123", ("123", "h.com")), ("https://h.com/p?x=/a/12", ("12", "h.com")),
    ("https://h.com/auktion/x", (None, "auktion")), ("https://h.com/da/123/", (None, "da")),
    ("https://h.com/da/123#t", (None, "da")), ("https://h.com/da/123\n", (None, "da"))]


def test_product_address(spark):
    rows = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(PRODUCT_ADDRESS)], "i int, url string").select(
        "i", product_id(F.col("url"), PRODUCT_URL_REGEX).alias("id"), product_slug(F.col("url")).alias("slug"))
    assert {r["i"]: (r["id"], r["slug"]) for r in rows.collect()} == {i: found for i, (_, found) in enumerate(PRODUCT_ADDRESS)}


def enriched(spark, rows):
    """(url, title, text, type, version) -> enriched documents."""
    docs = []
    for url, title, text, kind, version in rows:
        body = {"children": [{"text": text}]} if text is not None else None
        meta = {"fetchedAt": "2024-01-01T00:00:00.000Z", "domain": "h", "selector_mode": "ai", "contentHash": "c", "simhash": None, "aiConfidence": 0.6}
        docs.append((url, title, body, "", meta, kind, version))
    return spark.createDataFrame(docs, T.StructType(ENRICHED.fields + [T.StructField("version", T.LongType())]))


def batches(spark, rows, cuts):
    edges = [0, *cuts, len(rows)]
    return [enriched(spark, rows[a:b]) for a, b in zip(edges, edges[1:]) if a < b]


def content(table):
    return sorted(map(str, table.read().collect()))


def test_any_split_into_batches_gives_the_same_table(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"https://h.com/x/{rng.randrange(30)}", f"t{i}", f"text {i}", rng.choice(["page", "product", None]), i) for i in range(120)]
    rng.shuffle(rows)
    found = []
    for n, cuts in enumerate([[], [60], [10, 20, 90]]):
        table = pages_table(spark, str(tmp_path / f"t{n}"), buckets=5)
        for i, batch in enumerate(batches(spark, rows, cuts)):
            table.upsert(page_rows(batch), f"b{i}")
        found.append(content(table))
    assert found[0] == found[1] == found[2]
    latest = {url: (v, title) for url, title, _, _, v in sorted(rows, key=lambda r: r[4])}
    read = {r["url"]: (int(r["version"]), r["title"]) for r in pages_table(spark, str(tmp_path / "t2"), 5).read().collect()}
    assert read == latest


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    table = products_table(spark, str(tmp_path / "p"), buckets=4)
    first, second = (product_rows(enriched(spark, [("https://h.com/a/1", t, None, None, v), ("https://h.com/b", t, None, None, v)]))
                     for t, v in (("old", 1), ("new", 2)))
    table.upsert(first, "b0")
    table.upsert(second, "b1")
    before = content(table)
    table.upsert(second, "b1")
    table.upsert(first, "b0")
    assert content(table) == before and "new" in before[0] and len(before) == 1


def test_older_versions_lose_to_newer_in_any_batch(spark, tmp_path):
    table = pages_table(spark, str(tmp_path / "big"), buckets=4)
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "old", "x", None, i) for i in range(50)])), "b0")
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "new", "x", None, i + (100 if i % 2 else -100)) for i in range(60)])), "b1")
    rows = {r["url"]: r["title"] for r in table.read().collect()}
    assert len(rows) == 60 and sum(t == "new" for t in rows.values()) == 25 + 10
    assert [r["title"] for r in table.get("https://h.com/1").collect()] == ["new"] and table.get("https://no/").count() == 0
    table.compact()
    assert {r["url"]: r["title"] for r in table.read().collect()} == rows


def test_hot_url_and_untouched_buckets(spark, tmp_path):
    table = pages_table(spark, str(tmp_path / "hot"), buckets=8)
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "t", "x", None, i) for i in range(200)])), "b0")
    table.upsert(page_rows(enriched(spark, [("https://h.com/7", f"n{i}", "x", None, 1000 + i) for i in range(500)]).repartition(8)), "b1")
    rows = {r["url"]: r["title"] for r in table.read().collect()}
    assert len(rows) == 200 and rows["https://h.com/7"] == "n499"


def test_died_job_leaves_nothing_that_is_read(spark, tmp_path):
    """A delta without its version file is never read; running the batch again writes it anew."""
    table = pages_table(spark, str(tmp_path / "crash"), buckets=4)
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "old", "x", None, i) for i in range(40)])), "b0")
    new = page_rows(enriched(spark, [(f"https://h.com/{i}", "new", "x", None, i + 100) for i in range(40)]))
    publish = table._publish
    table._publish = lambda version: (_ for _ in ()).throw(RuntimeError("died before its version file"))
    with pytest.raises(RuntimeError):
        table.upsert(new, "b1")
    table._publish = publish
    assert {r["title"] for r in table.read().collect()} == {"old"} and len(table._folder.names("deltas")) == 2
    table.upsert(new, "b1")
    assert {r["title"] for r in table.read().collect()} == {"new"} and table.read().count() == 40


def test_a_reader_never_harms_the_writer(spark, tmp_path):
    """A plan built before an upsert and a compaction still reads its own rows; the new rows are all there after."""
    table = pages_table(spark, str(tmp_path / "race"), buckets=1)
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "old", "x", None, i) for i in range(5)])), "b0")
    reader = pages_table(spark, str(tmp_path / "race"))
    before = reader.read()
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", "new", "x", None, 10 + i) for i in range(5)])), "b1")
    table.compact()
    assert {r["title"] for r in before.collect()} == {"old"} and before.count() == 5
    assert {r["title"] for r in reader.read().collect()} == {"new"} and reader.read().count() == 5
    assert reader.current()["buckets"] == 1  # the count stored with the table, not the reader's default


def test_small_batch_writes_only_its_rows(spark, tmp_path):
    table = pages_table(spark, str(tmp_path / "grow"), buckets=4)
    table.upsert(page_rows(enriched(spark, [(f"https://h.com/{i}", f"title {i * 7919 % 3001}", " ".join(str(i * j % 9973) for j in range(100)), None, i)
                                               for i in range(3000)])), "big")
    table.upsert(page_rows(enriched(spark, [("https://h.com/1", "n", "y", None, 10_000)])), "small")

    def size(name):
        return table._folder.fs.getContentSummary(table._folder._at(name)).getLength()

    small, big = (size(n) for n in table.current()["deltas"][::-1])
    assert small * 20 < big
    assert [r["title"] for r in table.get("https://h.com/1").collect()] == ["n"] and table.read().count() == 3000
    table.compact()
    gone = table.vacuum(keep=1)
    assert len(gone) == 2 and table.read().count() == 3000 and len(table._folder.names("_versions")) == 1


def test_embeddings_keep_vector_when_text_is_gone(spark, tmp_path):
    table = embeddings_table(spark, str(tmp_path / "e"), buckets=2)
    rows = [("https://h.com/a", "", "ab", "page", 1), ("https://h.com/a", "T", None, "page", 2), ("https://h.com/b", "B", "", "page", 3)]
    table.upsert(embedding_rows(enriched(spark, rows), dim=4), "b0")
    (row,) = table.read().collect()
    assert row["title"] is None and row["embedding"] == pytest.approx([97 / 255, 98 / 255, 0, 0])


def test_page_keeps_empty_title(spark):
    row = page_rows(enriched(spark, [("https://h.com/a", "", "x", "", 1)])).first()
    assert row["title"] == "" and row["detectedType"] == "page"


def test_lake(spark, tmp_path):
    rows = [("https://a_b~c.com/x", "2025-12-31T23:59:59.999Z", '{"a":1}'), ("https://h.com/", None, '{"b":2}'),
            ("https://h.com/", "2025-12-31T23:59:59-02:00", '{"c":3}')]
    results = spark.createDataFrame(rows, "sitesUrl string, fetchedAt string, value string")
    lake = lake_rows(results, now=F.lit("2024-05-05 01:00:00").cast("timestamp"))
    stamps = {r["value"]: r["stamp"] for r in lake.collect()}
    assert stamps['{"a":1}'] == "2025-12-31T23-59-59-999Z"
    for _ in range(2):
        lake_write(lake, str(tmp_path / "lake"), batch="b0")
    got = sorted((r["dt"], r["domain"], r["value"]) for r in read_lake(spark, str(tmp_path / "lake")).collect())
    assert got == [("2024-05-05", "h.com", '{"b":2}'), ("2025-12-31", "a_b_c.com", '{"a":1}'), ("2026-01-01", "h.com", '{"c":3}')]


def test_a_lake_batch_replaces_all_that_it_wrote_before(spark, tmp_path):
    path = str(tmp_path / "lake")
    shape = "value string, dt string, domain string"
    lake_write(spark.createDataFrame([("a", "2024-01-01", "h.com"), ("b", "2024-01-02", "h.com")], shape), path, "b0")
    lake_write(spark.createDataFrame([("c", "2024-01-01", "h.com")], shape), path, "b1")
    lake_write(spark.createDataFrame([("b", "2024-01-02", "h.com")], shape), path, "b0")
    assert sorted(r["value"] for r in read_lake(spark, path).collect()) == ["b", "c"]


def test_lake_files_are_compressed(spark, tmp_path):
    path, line = tmp_path / "lake", '{"text":"' + "one line of many " * 2000 + '"}'
    lake_write(spark.createDataFrame([(line, "2024-01-01", "h.com")] * 20, "value string, dt string, domain string"), str(path), "b0")
    assert sum(f.stat().st_size for f in path.rglob("part-*")) * 10 < 20 * len(line)
    assert [r["value"] for r in read_lake(spark, str(path)).distinct().collect()] == [line]


def test_the_plan_of_a_read_does_not_grow_with_the_deltas(spark, tmp_path):
    """Ties of versions still go to the later delta, also beside deltas named in the earlier form."""
    table = pages_table(spark, str(tmp_path / "many"), buckets=2)
    for n in range(5):
        table.upsert(page_rows(enriched(spark, [("https://h.com/hot", f"title {n}", "x", "page", 7), (f"https://h.com/{n}", "t", "x", "page", n)])), f"b{n}")
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # the newest rows and their keys
    assert table.read().count() == 6 and table.get("https://h.com/hot").first()["title"] == "title 4"
    version = table.current()
    table._folder.move(version["deltas"][0], "deltas/b0-earlier")
    table._publish(version | {"deltas": ["deltas/b0-earlier", *version["deltas"][1:]]})
    assert table.read().count() == 6 and table.get("https://h.com/hot").first()["title"] == "title 4"


def test_a_stream_of_one_topic_reads_and_drops_only_its_files(spark, tmp_path):
    log, lake = str(tmp_path / "log"), str(tmp_path / "lake")
    rows = spark.range(40).select(F.explode(F.array(F.lit("results.raw"), F.lit("results.enriched"))).alias("topic"),
                                  F.format_string('{"sitesUrl":"https://h.com/%d","meta":{"fetchedAt":"2024-01-01T00:00:00.000Z"}}', "id").alias("value"))
    for n in range(4):
        write_topics(rows.coalesce(1), log, f"b{n}", gather=False)
    run = stream_lake(spark, log, str(tmp_path / "c"), lake, files_per_trigger=1, drop_read=True)
    run.awaitTermination()
    assert [p["numInputRows"] for p in run.recentProgress if p["numInputRows"]] == [40] * 4
    assert read_lake(spark, lake).count() == 160
    assert read_topics(spark, log, ["results.enriched"]).count() == 160
    assert read_topics(spark, log, ["results.raw"]).count() < 160
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    with pytest.raises(ValueError):
        read_topics(spark, log, ["results.raw", "results.enriched"], streaming=True, drop_read=True)


def test_task_files_hold_few_records(spark, tmp_path):
    rows = spark.range(100).select(F.lit("crawl.initial").alias("topic"), F.col("id").cast("string").alias("value"))
    write_topics(rows, str(tmp_path / "log"), "b", 30)
    log = read_topics(spark, str(tmp_path / "log"), ["crawl.initial"])
    assert log.count() == 100 and log.select(F.input_file_name()).distinct().count() >= 4


def test_new_urls_is_idempotent_and_takes_first(spark):
    rows = [(i, "https://hot.com/" if i % 3 else f"https://h.com/{i % 40}") for i in range(2000)]
    tasks = spark.createDataFrame(rows, "seq int, url string").repartition(8)
    once = new_urls(tasks)
    first = {}
    for seq, url in rows:
        first.setdefault(url, seq)
    assert {r["url"]: r["seq"] for r in once.collect()} == first
    assert new_urls(tasks, once).count() == 0
    assert new_urls(tasks, once, recrawl=True).count() == len(first)


def test_new_content(spark):
    pages = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "seq int, content_hash string")
    seen = spark.createDataFrame([("b",)], "content_hash string")
    assert sorted(r["seq"] for r in new_content(pages, seen).collect()) == [1, 4]


def test_same_content_with_one_hot_hash(spark):
    rows = [("hot" if i % 3 == 0 else f"c{i}", f"u{i}") for i in range(900)] + [("c1", "u1"), ("c1", "other")]
    got = same_content(spark.createDataFrame(rows, "content_hash string, url string").repartition(8)).collect()
    assert len(got) == 302 and {(r["content_hash"], r["n_urls"]) for r in got} == {("hot", 300), ("c1", 2)}


def test_lookups(spark):
    docs = enriched(spark, [("https://h.com/a/1", "x", "t", "product", 1), ("https://h.com/b/2", "y", "t", "page", 2),
                            ("https://h.com/a/3", "z", "t", "product", 3)])
    assert [r["url"] for r in latest_by_type(page_rows(docs), "product", 1).collect()] == ["https://h.com/a/1"]
    keys = spark.createDataFrame([("2", None), (None, "a"), (None, None)], "productId string, slug string")
    assert sorted(r["productId"] for r in products_lookup(product_rows(docs), keys).collect()) == ["1", "2", "3"]
