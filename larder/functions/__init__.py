"""Column-level building blocks.

Most helpers take SQL expression text and return SQL expression text, so they
compose inside higher-order functions and reach Spark as one expression.
"""
