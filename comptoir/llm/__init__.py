"""Operators for preparing training data: deduplication, scoring, scanning, mixing and packing."""
