"""Operators for preparing training data: scoring, encoding, searching, joining and packing of texts."""
