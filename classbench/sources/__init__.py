"""Readers, fixtures built from the given tables, and sinks."""
