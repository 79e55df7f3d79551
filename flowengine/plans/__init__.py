"""The named queries, over the driver's tables."""
