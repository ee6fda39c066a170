"""Readers, generated sources and table sinks."""
