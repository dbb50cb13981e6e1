"""Whole analytics assembled from the operators."""
