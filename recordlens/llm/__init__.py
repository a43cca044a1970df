"""Training-data pipeline operators (quality, language, near-duplicates, packing, ...).

Nothing else in the library imports this subpackage.
"""
