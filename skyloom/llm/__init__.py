"""Operators of the training-data pipeline; nothing outside this subpackage imports them."""
