import random

from pyspark.sql import Observation
from pyspark.sql import functions as F

from crawlweave.operators import metrics


def test_inflight_never_below_zero_and_independent_of_slices(spark):
    """Ends without a start are held at zero, whatever the slice length; one origin has most rows."""
    rng = random.Random(11)
    moments = rng.sample(range(100_000), 1200)
    steps = [("hot" if i % 3 else f"o{i % 5}", t, rng.choice([1, 1, -1, -1, -1])) for i, t in enumerate(moments)]
    expected = {}
    level = {}
    for origin, t, step in sorted(steps, key=lambda s: s[1]):
        level[origin] = max(0, level.get(origin, 0) + step)
        expected[origin, t] = level[origin]
    frame = spark.createDataFrame(steps, "origin string, t long, step long").select("origin", F.timestamp_seconds("t").alias("ts"), "step", "t")
    for seconds in (60, 3600, 10_000_000):
        got = metrics._level(frame.select("origin", "ts", "step"), seconds).select("origin", F.unix_seconds("ts").alias("t"), "inflight")
        assert {(r["origin"], r["t"]): r["inflight"] for r in got.collect()} == expected


def test_peak(spark):
    rows = [("a", 0, 10), ("a", 5, 15), ("a", 10, 20), ("b", 0, 0)]
    log = spark.createDataFrame(rows, "origin string, s long, e long").select(
        "origin", F.timestamp_seconds("s").alias("started_at"), F.timestamp_seconds("e").alias("ended_at"))
    assert {r["origin"]: r["peak"] for r in metrics.peak_inflight(log).collect()} == {"a": 2, "b": 0}


def test_queue_depth_of_unread_topic(spark):
    log = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "topic string, offset long")
    marks = spark.createDataFrame([("a", 0)], "topic string, committed long")
    assert {r["topic"]: r["depth"] for r in metrics.queue_depth(log, marks).collect()} == {"a": 1, "b": 1}


def test_histogram_defaults_and_nulls(spark):
    rows = spark.createDataFrame([(0.05,), (0.3,), (7.0,), (None,)], "value double")
    got = {r["le"]: r["n"] for r in metrics.latency_histogram(rows).collect()}
    assert got == {"0.05": 1, "0.1": 1, "0.25": 1, "0.5": 2, "1": 2, "2": 2, "5": 2, "+Inf": 3}


def test_gauge_ties(spark):
    rows = spark.createDataFrame([("x", 1, 1, 5.0), ("x", 1, 2, 6.0), ("x", 0, 9, 7.0)], "l string, s long, event_id long, value double")
    got = metrics.gauge_last(rows.withColumn("ts", F.timestamp_seconds("s")), ("l",)).first()
    assert got["value"] == 6.0


def test_observed_outcomes(spark):
    rows = spark.createDataFrame([("ok",), ("ok",), ("dlq",)], "outcome string")
    seen = Observation("step")
    metrics.observed(rows, seen).count()
    assert seen.get == {"rows": 3, "ok": 2, "retry": 0, "dlq": 1}
