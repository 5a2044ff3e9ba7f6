"""Operators of a training-data pipeline: tokenizing, archives, secret scans, language
identification, exact search, packing, id files, quality rules, near-duplicates, sharding."""
