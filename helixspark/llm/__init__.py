"""Training-data operators: packing, deduplication, scans, scoring, encoding, formatting.

Nothing else in the library imports this subpackage; ``queries`` registers one query
per operator. Every operator selects the columns it needs by name, so extra columns of
any name are ignored.
"""
