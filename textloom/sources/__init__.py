"""Readers, writers and the shared scratch location."""
