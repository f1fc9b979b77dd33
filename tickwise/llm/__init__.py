"""Operators of a training-data pipeline, each over whole tables.

Nothing else in the package imports this folder; ``__spark_entry__`` adds its
queries (``tickwise.llm.queries``) only when it can be imported.
"""
