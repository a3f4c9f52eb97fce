"""Operators for preparing training data from tables of texts."""
