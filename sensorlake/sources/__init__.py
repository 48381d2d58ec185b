"""Readers of the archive landing zone, the message bus and the API responses."""
