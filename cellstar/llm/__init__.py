"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage; ``registry`` holds the
queries that ``__spark_entry__`` adds when the subpackage is present.
"""
