"""Operators built from DataFrame primitives: rank, sampling, splits, preprocessing,
aggregates, models and evaluation tables."""
