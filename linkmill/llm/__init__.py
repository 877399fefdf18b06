"""Operators for training data at scale: near-duplicates, mixing, formatting, scans, fingerprints, packing."""
