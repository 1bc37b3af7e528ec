"""Operators of a training-data pipeline: dedup, search, mixing, packing, counting, filtering.

Every operator takes and returns DataFrames, reads whole tables and whole texts, and keeps rows with null
or empty values with the result its docstring names. ``queries`` holds the registered queries.
"""
