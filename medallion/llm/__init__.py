"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it. Each operator takes DataFrames and
returns DataFrames; ``queries`` holds the registered ``opN_<name>`` queries.
"""
