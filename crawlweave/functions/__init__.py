"""Scalar functions: Columns where Spark can express them, Arrow helpers where it cannot."""
