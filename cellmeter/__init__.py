"""Cellular modem log analytics as Spark DataFrame functions."""
