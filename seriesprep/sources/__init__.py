"""Readers, writers and the hourly table derived from an event log."""
