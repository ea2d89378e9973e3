"""Training-data operators: tokenised output, extraction, deduplication, packing and scoring.

Nothing outside this subpackage imports it.
"""
