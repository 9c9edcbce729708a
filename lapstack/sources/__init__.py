"""Readers for landed files and writers for tables and bundles."""
