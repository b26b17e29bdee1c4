"""Readers, written intermediate tables and sinks."""
