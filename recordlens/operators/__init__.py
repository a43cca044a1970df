"""Relational operators of the library, each DataFrame(s) -> DataFrame."""
