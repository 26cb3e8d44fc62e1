"""Readers and writers. Only this package touches storage."""
