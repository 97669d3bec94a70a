"""Structured Streaming form of the cascade."""
