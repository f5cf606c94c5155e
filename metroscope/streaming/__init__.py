"""Snapshot feeds as file streams."""
