"""Operators for training-data pipelines.

Thirteen operators over ``documents``, ``embeddings`` and ``conversations``, each in a module
of its own; ``registry`` holds the queries that apply them to whole tables.
Nothing else in the library imports this package.
"""
