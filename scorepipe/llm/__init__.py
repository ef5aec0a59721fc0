"""Operators of a training-data pipeline: filtering, de-duplication, archives, tokens, shards.

Nothing else in the library imports this package. ``queries`` registers one query per operator.
"""
