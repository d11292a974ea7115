"""Operators for preparing training data: mixing, personal data, near
duplicates, search, quality rules, token files, web archives and BPE.

Nothing else in the library imports this subpackage.
"""
