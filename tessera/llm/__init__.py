"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
catalogue only where it is installed.
"""
