"""Curve and scenario analytics as plain DataFrame -> DataFrame functions on Spark."""
