"""Structured Streaming jobs that run until nothing new is there."""
