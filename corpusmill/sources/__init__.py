"""Readers, writers and corpus-shaping sources."""
