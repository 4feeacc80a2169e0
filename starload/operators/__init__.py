"""Operators: schema conform, dimensions and facts, relational tables."""
