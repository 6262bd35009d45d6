"""Dimension, fact and mart builds composed from the operators."""
