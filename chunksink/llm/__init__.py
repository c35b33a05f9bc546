"""Training-data operators: deduplication, decontamination, filtering, tokenisation.

Nothing outside this subpackage imports it.
"""
