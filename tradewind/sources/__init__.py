"""Readers and writers: topics, tables and result sinks."""
