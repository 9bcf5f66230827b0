"""Operators for preparing training data: dedup, sharding, packing, filters, token files, mixing.

Nothing else in the package imports this one. Each operator is a function from DataFrame to
DataFrame; `queries` applies them to the given tables.
"""
