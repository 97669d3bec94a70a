"""Operators of a training-data pipeline: cleaning, de-duplication, scoring, tokenising, sharding.

Nothing else in the library imports this subpackage.
"""
