"""Operators of a training-data pipeline over web-scale text tables.

Every operator takes a DataFrame with an id column and a text column, selects
only the columns it names (further columns, whatever their names, are ignored)
and returns its own columns. Nothing outside this package imports it.
"""
