"""Operators of a training-data pipeline: language id, quality, near-duplicates, tokenizers, mixing, chat."""
