"""Operators for training-data corpora: one module per operator, queries and SQL beside them."""
