"""Readers, writers and named result tables."""
