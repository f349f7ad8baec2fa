"""Readers: files with explicit schemas, and the star-schema tables."""
