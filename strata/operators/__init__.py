"""Operators: pure functions DataFrame -> DataFrame. None runs a Spark action."""
