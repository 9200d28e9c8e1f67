"""Operators for large-scale training-data pipelines.

Nothing outside this subpackage imports it.  Every module holds one operator;
``queries`` registers the checked queries and their DuckDB SQL.
"""
