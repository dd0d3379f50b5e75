"""Feedback analytics on Spark: land, unify, enrich, measure and report."""
