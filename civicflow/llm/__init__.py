"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``queries`` registers one query per operator.
"""
