"""Assembled pipelines: bronze, silver, marts, serving queries and quality checks."""
