"""Scalar column functions and small numeric helpers."""
