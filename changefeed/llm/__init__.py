"""Operators of a training-data pipeline; nothing else in the library imports them.

Every operator takes and returns DataFrames. Columns of the input that an
operator does not name never reach it, so they may have any names.
"""
