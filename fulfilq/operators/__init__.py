"""Operators: cleanse, dedup, SCD2, dimensions, upsert, quality checks and marts."""
