"""Readers: delimited files, stored tables, and star-schema stand-ins."""
