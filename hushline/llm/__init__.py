"""Operators of a training-data pipeline: tokens, packing, archives, near copies, quality, scoring."""
