"""Operators for training-data pipelines: one module each, plus the queries in ``entries``."""
