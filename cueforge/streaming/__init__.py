"""Cue files as a stream."""
