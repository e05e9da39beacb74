"""Operators for preparing training text: sharding, tokens, quality, near copies, packing."""
