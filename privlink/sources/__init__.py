"""Readers and writers, and the test-table mapping."""
