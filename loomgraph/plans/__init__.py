"""Larger plans: metapaths and the staged pipeline."""
