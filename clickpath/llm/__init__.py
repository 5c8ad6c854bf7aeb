"""Operators for preparing training text: scoring, deduplication, decontamination,
sharding, fingerprints, chat formatting, packing and token files.

Nothing else in the library imports this subpackage.
"""
