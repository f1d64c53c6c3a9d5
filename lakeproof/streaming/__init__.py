"""Layers fed by a file stream."""
