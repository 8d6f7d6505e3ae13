"""Imports as a stream."""
