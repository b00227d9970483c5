"""Operators of a training-data pipeline: tokenising, decontamination, deduplication, classifiers, archives."""
