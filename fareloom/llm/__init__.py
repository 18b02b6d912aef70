"""Operators of a training-data pipeline: filter, score, deduplicate, mix, pack, search, archive.

Each module holds one operator as functions from DataFrame to DataFrame; `queries` binds them to
the tables. Operators name the columns they read, return only the columns they define, and never
look at others, so extra columns and clashing names do no harm.
"""
