"""Readers, writers and record parsing."""
