"""Structured Streaming: topic sinks, streaming compaction, transaction assembly, the replication job."""
