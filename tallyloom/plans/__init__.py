"""Whole reports and loads, composed from the operators."""
