"""Whole calculations made of the operators."""
