"""Training-data operators: filtering, deduplication, tokenization and placement.

Nothing else in the library imports this subpackage.
"""
