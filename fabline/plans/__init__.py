"""Composed jobs of the line and the registry of named queries."""
