"""Operators for training data: near copies, extraction, quality, safety, packing and audits."""
