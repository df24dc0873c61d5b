"""Training-data operators: scoring, extraction, tokenising, near duplicates, packing.

Nothing outside this subpackage imports it.
"""
