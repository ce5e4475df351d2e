"""DataFrame operators: scope, delays, ordered tracks, map layers."""
