"""Readers: pages, headline files, notifications, relational tables."""
