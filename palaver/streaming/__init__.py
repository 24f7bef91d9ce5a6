"""Structured Streaming: hops, keyed sinks and stateful reports on the batch functions."""
