"""Sources and sinks: topics, page snapshots, the raw lake, keyed tables."""
