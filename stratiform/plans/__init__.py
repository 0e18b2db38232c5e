"""Compositions of operators into the layered models."""
