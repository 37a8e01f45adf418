"""Training-data operators: deduplication, filtering, formatting and tokenised output.

Nothing outside this subpackage imports it.
"""
