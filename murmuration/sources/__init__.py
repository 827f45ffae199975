"""Readers, writers and the mapping of star-schema tables to social tables."""
