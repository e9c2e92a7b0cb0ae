"""Estimators on feature tables."""
