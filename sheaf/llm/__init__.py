"""Operators for preparing training data; each module is one operator.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator and ``oracle`` holds the DuckDB twins of those that SQL can
express.
"""
