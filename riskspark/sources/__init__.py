"""Readers, sinks and the source manifest."""
