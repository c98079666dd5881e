"""Incremental runs over newly captured pages."""
