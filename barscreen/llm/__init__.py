"""Operators for training-data pipelines: quality, chat, language, packing, mixing, dedup, URLs, toxicity, WARC."""
