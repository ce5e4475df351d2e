"""Readers of track files, airport files and sample tables."""
