"""Relational operators: cleaning, quality checks, joins, filters, sequencing."""
