"""Operators on DataFrames. Those that depend on where rows were cut write a table first; the others are lazy."""
