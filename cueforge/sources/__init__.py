"""Readers and writers of cue files."""
