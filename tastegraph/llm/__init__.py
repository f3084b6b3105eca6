"""Operators of a training-data pipeline: search, tokens, languages, secrets, archives, dedup, pages, mixing."""
