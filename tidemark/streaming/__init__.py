"""Incremental materialisation driven by Structured Streaming."""
