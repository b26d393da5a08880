"""Operators for training-data pipelines: scoring, de-duplication, mixing, packing, formatting.

Nothing else in the library imports this subpackage. Each module states its method, its parameters
and its result for nulls, empty and very long texts, ties, repeated rows and empty tables.
"""
