"""Whole jobs: product, price, mobile and history exports."""
