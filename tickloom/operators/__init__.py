"""Operators over panels of bars."""
