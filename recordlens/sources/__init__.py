"""Readers: raw delimited files, clean tables, JSON reports, test tables."""
