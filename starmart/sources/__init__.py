"""Readers: newline-delimited JSON, stored star schemas, and the bundled sample tables."""
