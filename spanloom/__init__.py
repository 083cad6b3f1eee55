"""Span-table jobs on Spark."""
