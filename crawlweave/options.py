"""Job options with the reference's default values."""

from __future__ import annotations

from dataclasses import dataclass

# Topic names.
TOPIC_INITIAL = "crawl.initial"
TOPIC_REVISIT = "crawl.revisit"
TOPIC_PRIORITY = "crawl.priority"
TOPIC_RETRY_30S = "crawl.initial.retry.30s"
TOPIC_RETRY_5M = "crawl.initial.retry.5m"
TOPIC_DLQ = "crawl.initial.dlq"
TOPIC_RESULTS_DB = "results.db"
TOPIC_RESULTS_RAW = "results.raw"
TOPIC_ENRICHED = "results.enriched"

TASK_TOPICS = (TOPIC_PRIORITY, TOPIC_REVISIT, TOPIC_INITIAL, TOPIC_RETRY_30S, TOPIC_RETRY_5M)
RESULT_TOPICS = (TOPIC_RESULTS_DB, TOPIC_RESULTS_RAW)
RETRY_DELAY_SECONDS = {TOPIC_RETRY_30S: 30, TOPIC_RETRY_5M: 300}

# Consumer groups; each is one streaming query with its own checkpoint.
GROUP_WORKER = "workers"
GROUP_ENRICH = "enrichers"
GROUP_PAGES = "page-writers"
GROUP_EMBEDDINGS = "embedding-writers"
GROUP_LAKE = "lake-writers"

# Limits.
MAX_DEPTH = 3
MAX_PER_ORIGIN = 4
TASKS_PER_FILE = 20_000
EMBEDDING_DIM = 384
IVF_LISTS = 100
LATENCY_BUCKETS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)

# Fixed value: a product address ends in "/<anything>/<digits>", a query may follow.
PRODUCT_URL_REGEX = r"/[^/]+/([0-9]+)(?:\?.*)?\z"


@dataclass(frozen=True)
class CrawlOptions:
    """Knobs of the crawl worker."""

    max_depth: int = MAX_DEPTH
    max_per_origin: int | None = MAX_PER_ORIGIN
    queue_in_batch: bool = False  # tasks of a full origin queue for its slots within the batch; else for the next round
    include_selectors: str = ""
    max_attempts: int | None = None
    recrawl: bool = False
