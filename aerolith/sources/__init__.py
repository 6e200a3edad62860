"""Readers of text, JSON, CSV, file inventories and streams."""
