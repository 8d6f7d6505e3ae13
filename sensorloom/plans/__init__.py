"""Operators composed into the tiers and the jobs around them."""
