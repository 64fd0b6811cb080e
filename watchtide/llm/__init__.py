"""Training-data operators: extraction, scoring, deduplication, mixing, sharding.

Nothing else in the library imports this subpackage.
"""
