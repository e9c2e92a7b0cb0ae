"""Operators of a training-data pipeline: filters, deduplication, scoring, decontamination and mixing of documents."""
