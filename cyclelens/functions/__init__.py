"""Scalar functions. Each takes Columns and returns one Column."""
