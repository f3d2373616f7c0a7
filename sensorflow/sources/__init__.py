"""Readers, writers and the partitioned readings store."""
