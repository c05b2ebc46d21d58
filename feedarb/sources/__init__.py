"""Feeds, catalogue and connectors."""
