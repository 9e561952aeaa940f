"""Operators for building training corpora: language, duplicates, toxicity, personal data, mixing, packing."""
