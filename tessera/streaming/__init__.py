"""Streaming.

The reference has no streaming source, watermark, window or state, so there
is no streaming operator here.  Every operator in this package takes and
returns DataFrames without calling an action on them, so the relational
ones (parsers, joins, aggregates) also apply to a ``readStream`` frame;
the ranking, split and SVD steps need a bounded input and stay batch-only.
"""
