"""Operators of a training-data pipeline (HTML extraction, quality rules, token
encoding and counting, packing, near-duplicates, chat formatting, language
identification, URL rules) and the queries that apply them to whole tables."""
