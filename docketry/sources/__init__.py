"""Readers and writers for captures, record tables and document bytes."""
