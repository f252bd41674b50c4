"""Readers and writers: feeds, raw logs, model tables."""
