"""Readers, writers and the binding of the driver tables to the model."""
