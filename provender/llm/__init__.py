"""Operators for building training data from large document tables."""
