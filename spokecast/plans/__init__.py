"""Builds that chain operators into the layered warehouse."""
