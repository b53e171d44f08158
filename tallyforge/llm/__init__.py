"""Operators for large-scale language-model training data.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; `queries.py` holds the registered `opN_*` queries and their SQL.
"""
