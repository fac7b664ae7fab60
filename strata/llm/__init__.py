"""Operators for training-data corpora: text, conversations, pages and token sequences."""
