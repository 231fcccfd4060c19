"""Operators for preparing large text corpora (ten operators and their queries).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when the package is present.
"""
