"""Operators of a training-data pipeline: cleaning, de-duplication,
decontamination, tokenisation, packing, sharding and formatting of text tables.

Nothing else in the library imports this subpackage.
"""
