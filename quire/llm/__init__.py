"""Operators for training-data pipelines over large text corpora.

One module per operator; ``queries`` holds the thin registered queries and
``oracles`` the DuckDB SQL of those that SQL can express. Nothing outside
this subpackage imports it.
"""
