"""Readers of landed files, the keyed merge, and layered tables."""
