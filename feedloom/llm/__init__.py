"""Operators for text corpora that models are trained on. Nothing outside this package imports it."""
