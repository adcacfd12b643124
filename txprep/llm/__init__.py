"""Operators of a training-data pipeline for language models.

Each module is one operator over Spark DataFrames; ``queries`` registers them
over the test tables. Nothing else in ``txprep`` imports this subpackage.
"""
