"""Readers: JSON-lines logs, lookup lists, summary tables and message streams."""
