"""Data sources: source-layout CSV ingestion and test-table adapters."""
