"""Readers: partitioned lake, operational tables, delimited files."""
