"""Feeds, landing and table folders."""
