"""Whole analyses composed from the operators, and their sinks."""
