"""Readers, declared schemas, writers and the test-table adapter."""
