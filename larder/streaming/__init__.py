"""The change feed."""
