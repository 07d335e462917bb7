"""Readers, writers, the calendar source and typed table contracts."""
