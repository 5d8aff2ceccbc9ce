"""Operators of a training-data pipeline: chat formatting, decontamination,
exact and near duplicates, quality rules, personal data, sharding, packing.

Nothing outside this folder imports it; ``queries.py`` registers one query
per operator.
"""
