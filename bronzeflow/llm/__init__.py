"""Operators for preparing training text at scale, their queries and DuckDB SQL.

Nothing outside this package, its tests and corpus_pipeline.py imports it.
"""
