"""Corpus curation and analytics as plain DataFrame -> DataFrame functions."""
