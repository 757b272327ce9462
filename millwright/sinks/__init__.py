"""Keyed metric tables, the alert table and the event archive."""
