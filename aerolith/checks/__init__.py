"""Data-quality checks, reconciliation, maintenance."""
