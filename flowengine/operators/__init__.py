"""DataFrame-to-DataFrame analytics."""
