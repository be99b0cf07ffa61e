"""Readers, one module per storage form; each returns a lazy DataFrame."""
