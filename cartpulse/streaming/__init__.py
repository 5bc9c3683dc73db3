"""Continuously maintained rollups."""
