"""Readers, writers and the versioned layer store."""
