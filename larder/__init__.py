"""Spark engine for product, price and revision datasets.

JSON lines become typed Parquet, prices are joined with their proofs and
locations, revisions become field-level change rows, and a change feed keeps
the newest revision of each product.  Everything is DataFrames and SQL
expressions; see README.md for the layout.
"""

__version__ = "0.1.0"
