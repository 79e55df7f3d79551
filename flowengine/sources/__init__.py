"""Readers for flow records and alerts."""
