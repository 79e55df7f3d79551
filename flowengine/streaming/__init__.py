"""Continuous detection."""
