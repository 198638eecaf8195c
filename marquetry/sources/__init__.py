"""Scans, table reads and writes, view registration, source manifest."""
