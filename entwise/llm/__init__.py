"""Operators for large text corpora: near-duplicates, token files, repeated
passages, secrets, packing, decontamination, vector search, licences, sharding
and language identification. Nothing else in the library imports this package.
"""
