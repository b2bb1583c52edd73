"""Readers, writers, lexicons and table profiles."""
