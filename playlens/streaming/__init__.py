"""Structured Streaming jobs over the activity-log file stream, and their state."""
