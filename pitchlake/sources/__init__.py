"""Readers of landed files. Schemas are explicit; nothing is inferred from values."""
