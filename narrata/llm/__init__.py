"""Training-data operators: deduplication, decontamination, packing, token files and more.

Nothing else in the library imports this subpackage.
"""
