"""Readers, writers and offline connectors."""
