"""Web-crawl data processing on Spark: every step of a crawl as a DataFrame operator, in batch and streaming."""
