"""Operators of a training-data pipeline over the `documents` and `pages`
tables.  Nothing outside this package imports it."""
