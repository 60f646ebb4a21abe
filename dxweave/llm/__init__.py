"""Operators of a training-data pipeline: quality, duplicates, packing, tokens, URLs, toxicity, language models."""
