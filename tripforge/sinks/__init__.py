"""Batch writers."""
