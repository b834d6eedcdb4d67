"""Readers, writers and report sinks."""
