"""Declared inputs and measures."""
