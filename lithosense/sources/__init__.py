"""Readers, writers and warehouse tables."""
