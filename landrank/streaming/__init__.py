"""Streams over the change log and over events."""
