"""Structured Streaming forms of scoring, validation, label arrival and monitoring."""
