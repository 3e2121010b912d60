"""Operators for preparing training text: filters, joins, searches, mixing and token output."""
