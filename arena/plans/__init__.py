"""Logical plans of the published metrics."""
