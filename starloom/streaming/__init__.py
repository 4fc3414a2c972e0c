"""Incremental loads driven by a run date. They are batch jobs; nothing here is a stream."""
