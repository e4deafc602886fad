"""Operators of a training-data pipeline (quality, privacy, sharding, mixing, …).

Nothing outside this package imports it; ``queries.py`` registers its queries.
"""
