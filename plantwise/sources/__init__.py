"""Readers, writers, catalog helpers and adapters from the driver tables."""
