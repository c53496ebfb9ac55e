"""Operators for large-scale training-data pipelines.

Thirteen operators, one module each, plus the queries that run them over whole
tables (``queries.py``).  Nothing outside this subpackage imports it.
"""
