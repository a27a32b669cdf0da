"""Builders of the canonical tables.

A builder takes relations with its documented input columns (a ``SourceMap`` per vendor provides them), the already
built tables it refers to, and the run context; it returns a lazy relation. Builders that number rows over all of a
table (attribute options, linked notes) run a job when they are called: range bounds must be the same for the counts and for
the numbers, so the ranged rows are stored first (``session.durable``).
"""
