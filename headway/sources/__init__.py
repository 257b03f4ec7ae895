"""Readers: topics, lake files, text lines, feed snapshots and dimensions."""
