"""Structured Streaming: conversation sessions and the contact update log."""
