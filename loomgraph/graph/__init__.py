"""Algorithms over edge tables."""
