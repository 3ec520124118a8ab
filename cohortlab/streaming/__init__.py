"""Streaming surface: the stateless transforms applied to a stream."""
