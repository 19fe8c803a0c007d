"""Operators for preparing training data at corpus scale.

Nothing outside this package imports it.  Every operator takes and returns
DataFrames; ``queries.py`` registers one thin query per operator.
"""
