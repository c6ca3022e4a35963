"""Velora: fleet analytics on Spark."""
