"""Streams of events."""
