"""Readers, writers and generated conversation tables."""
