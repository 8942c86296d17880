"""Operators for preparing training text: filters, deduplication, scans, packing.

Nothing else in the library imports this package. ``queries`` holds the
registered queries, ``stages`` the functions of the corpus pipeline.
"""
