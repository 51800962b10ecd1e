"""Operators for training-data pipelines: scoring, filtering, deduplication, decontamination and packing."""
