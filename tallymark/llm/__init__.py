"""Training-data operators: near-duplicate search, quality, packing and archive formats.

Nothing else in the library imports this subpackage.
"""
