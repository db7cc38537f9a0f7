"""Operators for training-data pipelines: near-duplicate joins, filters, classifiers, mixing, tokenizing.

Nothing else in the library imports this subpackage; ``queries`` holds its registered queries and SQL.
"""
