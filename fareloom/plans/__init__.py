"""Composed jobs over the operators."""
