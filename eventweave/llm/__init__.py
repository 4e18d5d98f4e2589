"""Operators for preparing training text: quality, similarity, packing, extraction, scans.

Each module is one operator with a general interface; ``queries`` registers a
thin query per operator over the given tables. Nothing outside this package
imports it.
"""
