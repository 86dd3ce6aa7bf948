"""The same operators inside Structured Streaming."""
