"""File-driven incremental ingestion."""
