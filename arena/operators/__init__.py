"""Normalisation, resolution, legality, quality and page operators."""
