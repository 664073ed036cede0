"""Readers of landed files, raw and staged tables, and their sinks."""
