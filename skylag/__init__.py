"""Flight-track delay analytics as Spark DataFrame operators."""
