"""Operators of a training-data pipeline: one module for each, and ``registry`` with their queries."""
