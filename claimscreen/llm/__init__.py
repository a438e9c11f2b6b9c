"""Operators for training corpora: counting, tokenizing, filtering, deduplicating and mixing documents."""
