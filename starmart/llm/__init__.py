"""Operators for training-data pipelines: filters, scores, near-duplicates, decontamination, sharding and packing."""
