"""Readers: tables by name, partitioned scans, delimited files and message streams."""
