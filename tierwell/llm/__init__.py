"""Operators for preparing training data: deduplication, filters, retrieval, tokenising, packing.

Nothing else in the library imports this subpackage."""
