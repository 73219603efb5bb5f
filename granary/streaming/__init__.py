"""Incremental ingestion of a stream of assets (beyond what batch curation needs)."""
