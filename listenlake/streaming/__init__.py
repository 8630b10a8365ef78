"""Structured Streaming jobs. All run until they have taken in what is there, then stop."""
