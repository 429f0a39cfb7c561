"""Structured Streaming versions of the row-local and conversation-state steps."""
