"""Operators that prepare text for training, and the queries that run them over whole tables."""
