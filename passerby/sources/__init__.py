"""Readers, feed parsing and sinks."""
