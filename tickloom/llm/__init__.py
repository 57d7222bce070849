"""Operators for training-data corpora; nothing else in tickloom imports this subpackage."""
