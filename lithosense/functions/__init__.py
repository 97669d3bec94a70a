"""Column expression builders (no actions, no UDFs)."""
