"""Composed query plans over the data folder's tables, and their SQL oracles."""
