"""Composite reports and the registry of named queries with their oracles."""
