"""Readers, writers and the per-source builders of block and block-year tables."""
