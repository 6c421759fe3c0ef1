"""Readers: readings, stored results, files, samples."""
