"""Structured Streaming trigger for the daily batch loads."""
