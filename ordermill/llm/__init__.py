"""Operators for preparing training text at scale: packing, near-duplicates, decontamination and the like.

Nothing else in the library imports this subpackage.
"""
