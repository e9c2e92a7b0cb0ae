"""Whole chains: raw text to clean table, clean table to feature table."""
