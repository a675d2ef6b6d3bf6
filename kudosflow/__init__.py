"""Layered review analytics on Spark: JSON records in, answer tables out."""
