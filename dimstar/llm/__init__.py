"""Operators of a training-data pipeline (extraction, dedup, filters, packing, search).

Each module holds one operator with its own interface; ``queries`` applies
the ten of them to the given tables.  Nothing else in the library imports
this subpackage.
"""
