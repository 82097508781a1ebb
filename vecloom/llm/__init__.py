"""Operators for preparing training text: tokens, scores, shards, copies, packing and search."""
