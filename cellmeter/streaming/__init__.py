"""Streaming runs of the batch operators."""
