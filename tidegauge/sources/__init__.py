"""Readers, writers and sinks."""
