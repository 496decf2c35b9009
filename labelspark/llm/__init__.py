"""Operators for preparing training data: filters, token counts, joins, packing, search and formatting."""
