"""Relational building blocks: deduplication, joins, ranks, merges, quality rules, profiles."""
