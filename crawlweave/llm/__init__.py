"""Operators for training data: each module holds one operator, ``queries`` applies them to the given tables."""
