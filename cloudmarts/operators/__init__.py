"""Relational operators: dedup, joins, fences, quality split, marts, serving."""
