"""Schemas, readers, dimensions, ledgers and writers."""
