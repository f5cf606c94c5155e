"""Analyses composed of operators."""
